"""Helpers shared by the operators: column picking, Arrow batches, shared folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Rows and bytes of one Arrow batch handed to a Python worker.  Texts differ
#: in length by orders of magnitude, so the byte limit is the one that holds.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by exact name and position.

    Extra columns may have any name, also one that differs from a wanted name
    only in case or repeats it (the first exact match counts), which a plain
    `select` would refuse as ambiguous.  Column pruning still reaches the scan.
    """
    at = [df.columns.index(n) for n in names]
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))).select(
        *(F.col(f"_{i}").alias(n) for i, n in zip(at, names)))


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_texts(rows: DataFrame, keep: tuple[str, ...], text: str, out: str,
              make: Callable[[], Callable[[list[str | None]], list[list]]]) -> DataFrame:
    """`keep`, unchanged, beside what a function makes of the texts of each Arrow batch.

    `make` is called once a task and gives that function: from a list of texts to one list for each
    column of `out` (DDL).  Kept columns stay Arrow arrays, so nulls and large integers survive.
    """
    small_batches(rows.sparkSession)
    made = StructType.fromDDL(out)
    schema = StructType([rows.schema[c] for c in keep] + made.fields)
    names, types = schema.fieldNames(), [to_arrow_type(f.dataType) for f in made.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            columns = work(b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(x, type=t) for x, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (`spark.checkpoint.dir`).

    Only a local session, as in tests, gets a folder of its own when the
    setting is missing; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not folder and sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc._jsc.sc().getCheckpointDir().get()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        folder = tempfile.mkdtemp(prefix="dayloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
