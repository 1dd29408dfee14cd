"""Readers for the four user logs (registration, launch, creation, activity).

Three ways in, all returning the same :class:`Logs` bundle:

* ``read_tsv_logs`` -- the raw tab-separated, header-less log files, read
  with an explicit schema (no inference pass over 100 TB of text);
* ``read_parquet_logs`` -- the same logs stored as parquet (the format to
  keep them in: column pruning and day filters reach the scan);
* ``fixture_logs`` -- views over the benchmark tables (``customer`` and
  ``events``) that give the four logs with the same shapes.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import ACTIVITY, CREATE, LAUNCH, REGISTER


@dataclass(frozen=True)
class Logs:
    register: DataFrame   # user_id, register_day, register_type, device_type
    launch: DataFrame     # user_id, day               (set semantics)
    create: DataFrame     # user_id, day               (one row per video)
    activity: DataFrame   # user_id, day, page, video_id, author_id, action_type


@dataclass(frozen=True)
class DayCounts(Logs):
    """Logs counted by day already (``plans/rollup.py``): launches once per user and day, creations with
    ``n``, activity with the day grain's counts, and ``items``: user_id, kind, item, day, n."""
    items: DataFrame


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema)
            .option("sep", "\t").option("header", "false")
            .option("mode", "FAILFAST")
            .csv(path))


def read_tsv_logs(spark: SparkSession, register: str, launch: str,
                  create: str, activity: str) -> Logs:
    return Logs(
        register=read_tsv(spark, register, REGISTER),
        launch=read_tsv(spark, launch, LAUNCH),
        create=read_tsv(spark, create, CREATE),
        activity=read_tsv(spark, activity, ACTIVITY),
    )


def write_tsv_logs(logs: Logs, root: str, mode: str = "overwrite") -> dict[str, str]:
    """The four logs in their raw form, header-less and tab-separated; returns the folders by log."""
    paths = {name: os.path.join(root, name) for name in ("register", "launch", "create", "activity")}
    for name, path in paths.items():
        getattr(logs, name).write.mode(mode).option("sep", "\t").option("header", "false").csv(path)
    return paths


def read_parquet_logs(spark: SparkSession, root: str) -> Logs:
    """``root/{register,launch,create,activity}`` parquet folders."""
    def rd(name, schema):
        df = spark.read.parquet(os.path.join(root, name))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return Logs(rd("register", REGISTER), rd("launch", LAUNCH),
                rd("create", CREATE), rd("activity", ACTIVITY))


def write_parquet_logs(logs: Logs, root: str, mode: str = "overwrite") -> None:
    """Store logs partitioned by day so day-range filters prune files."""
    logs.register.write.mode(mode).parquet(os.path.join(root, "register"))
    for name in ("launch", "create", "activity"):
        (getattr(logs, name).write.mode(mode).partitionBy("day")
         .parquet(os.path.join(root, name)))


# --- fixture views over the benchmark tables --------------------------------
#
# Fixed mapping (must stay as written so the SQL oracle sees the same rows):
#   register  <- customer: user_id = c_custkey,
#                register_day = 1 + (c_custkey * 7) % 30,
#                register_type = c_nationkey % 12,
#                device_type = (c_custkey * 13) % 97
#   launch    <- events with event_type 'view'
#   create    <- events with event_type 'purchase'
#   activity  <- all events; page from event_type
#                (click 0, error 1, purchase 2, signup 3, anything else 4),
#                video_id = props.k, author_id = video_id % 50,
#                action_type = video_id % 6
#   all logs  <- the first days from FIRST_DAY on, 30 unless a query wants more;
#                day = days since then, from 1

PAGE_OF_EVENT = {"click": 0, "error": 1, "purchase": 2, "signup": 3}
OTHER_PAGE = 4
FIRST_DAY, N_DAYS = "2024-01-01", 30


def _day_of(ts: Column) -> Column:
    return (F.datediff(ts, F.lit(FIRST_DAY).cast("date")) + 1).cast("int")


def month(events: DataFrame, days: int = N_DAYS) -> DataFrame:
    """Events of the logs' days, 1 to ``days``; a plain range on ``ts``, which reaches the scan."""
    kind = events.schema["ts"].dataType
    end = F.date_add(F.lit(FIRST_DAY).cast("date"), days)
    return events.where((F.col("ts") >= F.lit(FIRST_DAY).cast(kind)) & (F.col("ts") < end.cast(kind)))


def _page_of(event_type: Column) -> Column:
    expr = None
    for name, page in PAGE_OF_EVENT.items():
        expr = (F.when(event_type == name, F.lit(page)) if expr is None
                else expr.when(event_type == name, F.lit(page)))
    return expr.otherwise(F.lit(OTHER_PAGE)).cast("int")


def fixture_register(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.cast("long").alias("user_id"),
        (F.lit(1) + (key * 7) % 30).cast("int").alias("register_day"),
        (F.col("c_nationkey") % 12).cast("int").alias("register_type"),
        ((key * 13) % 97).cast("int").alias("device_type"),
    )


def fixture_launch(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "view")
            .select(F.col("user_id").cast("long").alias("user_id"),
                    _day_of(F.col("ts")).alias("day")))


def fixture_create(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "purchase")
            .select(F.col("user_id").cast("long").alias("user_id"),
                    _day_of(F.col("ts")).alias("day")))


def fixture_activity(events: DataFrame) -> DataFrame:
    video = F.get_json_object(F.col("props"), "$.k").cast("long")
    return (events
            .select(F.col("user_id").cast("long").alias("user_id"),
                    _day_of(F.col("ts")).alias("day"),
                    _page_of(F.col("event_type")).alias("page"),
                    video.alias("video_id"))
            .select("user_id", "day", "page", "video_id",
                    (F.col("video_id") % 50).alias("author_id"),
                    (F.col("video_id") % 6).cast("int").alias("action_type")))


def fixture_logs(spark: SparkSession, sf_dir: str, days: int = N_DAYS) -> Logs:
    customer = spark.read.parquet(os.path.join(sf_dir, "customer.parquet"))
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    return Logs(
        register=fixture_register(customer),
        launch=fixture_launch(month(events, days)),
        create=fixture_create(month(events, days)),
        activity=fixture_activity(month(events, days)),
    )


def logs_from_frames(spark: SparkSession, register, launch, create, activity) -> Logs:
    """Build logs from python rows / pandas frames (micro fixtures in tests)."""
    def mk(rows, schema):
        return spark.createDataFrame(rows, schema=schema)
    return Logs(mk(register, REGISTER), mk(launch, LAUNCH),
                mk(create, CREATE), mk(activity, ACTIVITY))
