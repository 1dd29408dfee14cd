"""Stored forms of the logs and blocks, so that a new week costs a week.

* ``add_days`` counts the raw rows of some days -- by user, and by user and item -- and
  stores the counts in folders by day; ``read_day_counts`` gives them back as the logs of a
  feature table.  A new week reads its own days of the raw logs; windows over past days
  read the counts' day folders.  Adding a day again replaces it, so a failed
  job is simply run again.
* ``bucketed`` stores the spine and the blocks of a feature table in buckets by window and
  user: they are joined bucket by bucket, without an exchange, as often as they are read.
* ``store_windows`` and ``launches_of_stored_windows``: windows as rows of a table
  instead of literals; their days prune the log's day folders while the job runs.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activity import CATEGORIES, activity_days, category_name
from ..operators.affinity import item_days
from ..operators.creation import user_days
from ..operators.windows import FeatureWindow
from ..sources.logs import DayCounts, Logs
from .features import KEYS

_COUNTS = ", ".join(f"{category_name(c, v)} long" for c, v in CATEGORIES)
SCHEMAS = {
    "register": "user_id long, register_type int, device_type int, register_day int",
    "launch": "user_id long, day int",
    "create": "user_id long, n long, day int",
    "activity": f"user_id long, n long, {_COUNTS}, day int",
    "items": "user_id long, kind string, item long, n long, day int",
}


def add_days(logs: Logs, root: str, first: int, last: int) -> None:
    """Count the logs' days ``first`` to ``last`` and store them under ``root``.

    Registrations are stored by their own day, those of these days only.  Days with rows
    replace what was stored for them (dynamic partition overwrite).  Rows are dealt by day before the write; AQE
    splits a large day and puts small ones together, so files are neither huge nor many.
    """
    def days(log: DataFrame) -> DataFrame:
        return log.where(F.col("day").between(first, last))

    counts = {
        "register": logs.register.where(F.col("register_day").between(first, last)),
        "launch": days(logs.launch).select("user_id", "day").distinct(),
        "create": user_days(days(logs.create)),
        "activity": activity_days(days(logs.activity)),
        "items": item_days(days(logs.activity)),
    }
    for name, rows in counts.items():
        by = "register_day" if name == "register" else "day"
        (rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(by).parquet(os.path.join(root, name)))


def read_day_counts(spark: SparkSession, root: str) -> DayCounts:
    """The stored counts; day ranges prune their folders."""
    return DayCounts(**{name: spark.read.schema(schema).parquet(os.path.join(root, name)) for name, schema in SCHEMAS.items()})


def bucketed(spark: SparkSession, root: str, buckets: int | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """``place`` for ``feature_table``: tables under ``root`` in buckets by window and user, as many as there are
    shuffle partitions, so that a task of the last shuffle writes its own buckets."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def place(block: DataFrame, name: str) -> DataFrame:
        table = f"{name}_{uuid.uuid4().hex}"
        (block.write.format("parquet").bucketBy(n, *KEYS).sortBy(*KEYS)
         .option("path", os.path.join(root, name)).saveAsTable(table))
        return spark.table(table)
    return place


def store_windows(spark: SparkSession, windows: Sequence[FeatureWindow], path: str) -> None:
    """A row for each feature day of each window: window_id, labelled, day, wday."""
    rows = [(w.window_id, w.labelled, day, day - w.slide) for w in windows for day in range(w.feat_begin, w.feat_end + 1)]
    spark.createDataFrame(rows, "window_id int, labelled boolean, day int, wday int").coalesce(1).write.parquet(path)


def launches_of_stored_windows(launch: DataFrame, windows: DataFrame) -> DataFrame:
    """``(window_id, user_id, wday)``, distinct, for the days in a table of ``store_windows`` (or rows of it).

    A log in folders by day is read on these days only: Spark prunes with the days it broadcasts.
    """
    return launch.select("user_id", "day").distinct().join(windows, "day").select("window_id", "user_id", "wday")
