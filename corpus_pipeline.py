"""The corpus pipeline: quality rules, near-dedup, decontamination, secret scan, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of `documents`; extra columns of the input, whatever their names, are
left behind.  Null texts fail the quality rules and go; null ids, languages and
sources pass through.  An empty table gives empty stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.llm import decontaminate, mixing, quality_rules as quality, secret_scan, simhash
from dayloom.llm.common import pick, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(found: DataFrame, text: str) -> DataFrame:
    """The columns of documents with a new text and its length."""
    return found.select("doc_id", F.col(text).alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and documents that the rules reject."""
    found = quality.quality_rules(pick(docs, *COLUMNS), carry=("lang", "source"))
    return _with_text(found.where("kept"), "clean_text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return simhash.one_of_each(pick(docs, *COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.clean(pick(docs, *COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are redacted; all documents stay."""
    found = secret_scan.secret_spans(pick(docs, *COLUMNS), carry=("lang", "source"))
    return _with_text(found, "redacted_text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that words of a document are taken (its first `words` words), in shards."""
    return mixing.shuffled(mixing.mix(pick(docs, *COLUMNS), carry=COLUMNS[1:]))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
]

#: DuckDB has neither XXH64 nor the mix's draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"stage-{n + 1}")
    return docs
