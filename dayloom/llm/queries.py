"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import conversation_trie as ct, decontaminate as dc, html_text as ht, mixing as mx, quality_rules as qr, secret_scan as ss, simhash as sh, suffix_dedup as sd
from . import token_align as ta, token_count as tc, url_filter as uf, weak_label as wl, word_table as wt
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tc.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qr.quality_rules(table(spark, sf_dir, "documents"), with_text=False)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wl.classify(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dc.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sh.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", sh.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ss.secret_spans(table(spark, sf_dir, "documents"), with_text=False)
    base = [r.kind for r in ss.BASE]
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in base),
        F.sha2(ss.joined_spans("spans", base), 256).alias("base_sha256"),
        ss.joined_spans("spans").alias("spans"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ht.extract(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mx.mix(table(spark, sf_dir, "documents"))
    shards = F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["epoch"], d["shard"], d["words"])), ",")
    return found.select("doc_id", "size", "source_size", "target", "taken", shards.alias("draws"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uf.url_verdicts(table(spark, sf_dir, "pages"), uf.rules_table(spark))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sd.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.prefix_trie(table(spark, sf_dir, "conversations"), openings=True)


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return wt.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return ta.aligned_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_quality_rules, op3_quality_classifier, op4_decontaminate, op5_simhash, op6_secret_scan, op7_html_text,
    op8_mixing, op9_url_filter, op10_suffix_dedup, op11_conversation_trie, op12_bpe_round_trip, op13_token_alignment,
)}
