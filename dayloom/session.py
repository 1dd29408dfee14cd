"""Spark session defaults for the feature engine.

On a cluster the session is created by the platform and only
``ensure_checkpoint_dir`` is used; ``local_session`` is for tests and the
local benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime settings every job of the engine relies on.  AQE re-plans joins
# and coalesces shuffle partitions from runtime statistics; skew-join
# splitting covers a hot user that holds a large share of the rows.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The activity rollup keeps one exact median per category; the
    # object aggregate behind it should stay hash based for a task's groups.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "dayloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # the wide feature plans build thousands of Column objects; skip the
        # per-call Python call-site capture (static conf, local sessions only)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # small local inputs: keep every core busy after AQE coalescing
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """The settings above (all of them runtime settings); what the platform has set stays."""
    platform = dict(spark.sparkContext.getConf().getAll())
    for k, v in ENGINE_CONF.items():
        if k not in platform:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    ``spark.checkpoint.dir`` wins, then a folder given to ``setCheckpointDir``.
    Without either a local session gets a scratch folder; on a cluster a folder
    of the driver's machine would lose what executors write, so that is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="dayloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
