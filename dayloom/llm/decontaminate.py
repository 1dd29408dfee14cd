"""Benchmark decontamination by n-gram windows; DataFrame functions only.

Words are runs of a-z, 0-9 and everything above ASCII, A-Z lower-cased.  Every
`WIDTH` consecutive words of an item are a window; an item with fewer words is one window
by itself.  The windows' hashes go out as a hash set (a broadcast join, while the
counted windows stay under `BROADCAST_WINDOWS`; a shuffle join beyond), every word
position of every text is looked up, and hits are verified word by word.

Scale: the texts never move.  Positions are generated, hashed and looked up inside one
code-generated stage, and only verified hits leave it, once for each distinct
text: hits depend on the text alone, so copies collapse map-side.  What a text's
windows cover is summed over its hits by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, written

WIDTH = 13
#: A document is contaminated if hit words times this reach its words.
SHARE = 20
#: Distinct windows up to which the hash set is broadcast (some 300 bytes each).
BROADCAST_WINDOWS = 200_000

#: Characters that part words, and runs of those that make them: fixed values of the contract.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Array of words with A-Z lower-cased, other letters as they are.

    `translate` looks at every character by itself, so it is left to words that some lower-casing would
    change, in texts that are not all ASCII.
    """
    def lowered(w: Column) -> Column:
        return F.when(F.lower(w) == w, w).otherwise(F.translate(w, _UPPER, _LOWER))

    return (F.when(F.octet_length(text) == F.char_length(text), F.array_remove(F.split(F.lower(text), GAP), ""))
            .otherwise(F.transform(F.array_remove(F.split(text, GAP), ""), lowered)))


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def digest(text: str) -> Column:
    """What tells texts apart: 128 bits."""
    return F.unhex(F.md5(text))


def windows(benchmark: DataFrame, width: int = WIDTH, item: str = "item_id", text: str = "text") -> DataFrame:
    """gram (array of words), item: the distinct windows of the items.  Items without words have none."""
    items = pick(benchmark, item, text).select(F.col(item).cast("string").alias("item"), words(text).alias("w")).where("size(w) > 0")
    return (items.withColumn("i", F.explode(F.expr(f"sequence(1, greatest(1, size(w) - {width - 1}))")))
            .select(F.expr(f"slice(w, i, {width})").alias("gram"), "item").distinct())


def hits(docs: DataFrame, grams: DataFrame, text: str = "text") -> DataFrame:
    """text_key, total (words), i (1-based), n, gram: verified occurrences of the distinct windows in the distinct texts."""
    distinct = grams.select("gram").distinct().select("gram", F.size("gram").alias("n"), F.xxhash64("gram").alias("h"))
    lengths = [(r["n"], r["m"]) for r in distinct.groupBy("n").agg(F.count(F.lit(1)).alias("m")).orderBy("n").collect()]
    texts = docs.select(digest(text).alias("text_key"), words(text).alias("w"))
    found = None
    for n, count in lengths:  # at most as many as a window has words
        side = distinct.where(F.col("n") == n).select("gram", "h")
        side = F.broadcast(side) if count <= BROADCAST_WINDOWS else side
        # the hash alone is the join's key (one long); the comparison names both sides in one term, so that it
        # stays a condition, and has no lambda, so that positions, hashes and look-ups stay one generated stage
        part = (texts.withColumn("i", F.explode(F.expr(f"if(size(w) >= {n}, sequence(1, size(w) - {n - 1}), array())")))
                .select("text_key", F.size("w").alias("total"), "i", F.expr(f"slice(w, i, {n})").alias("at"))
                .withColumn("h", F.xxhash64("at"))
                .join(side, "h").where(f"slice(concat(at, gram), 1, {n}) = gram")
                .select("text_key", "total", "i", F.lit(n).alias("n"), "gram"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.select("text_key", *(F.lit(0).alias(c) for c in ("total", "i", "n")), F.col("w").alias("gram")).where("false")
    return written(found.distinct(), "hits")


def hit_summary(found: DataFrame, grams: DataFrame) -> DataFrame:
    """text_key, total (words), n_hit (covered words), items (sorted ids), spans (array of [first word, end), 0-based, disjoint)."""
    order = Window.partitionBy("text_key").orderBy("i", "n")
    ends = (found.groupBy("text_key", "total", "i").agg(F.max("n").alias("n"))
            .withColumn("reach", F.max(F.col("i") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("fresh", F.expr("greatest(0, i + n - greatest(i, coalesce(reach, 0)))")))
    runs = (ends.withColumn("run", F.sum(F.expr("if(reach is null or i > reach, 1, 0)")).over(order))
            .groupBy("text_key", "total", "run").agg(F.min("i").alias("a"), F.max(F.col("i") + F.col("n")).alias("b"), F.sum("fresh").alias("fresh"))
            .groupBy("text_key", "total").agg(F.sum("fresh").alias("n_hit"),
                                     F.sort_array(F.collect_list(F.struct((F.col("a") - 1).alias("start"), (F.col("b") - 1).alias("end")))).alias("spans")))
    items = (found.select("text_key", "gram").distinct().join(grams, "gram")
             .groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    # written, so that a join with the documents deals out both sides afresh and Spark can split a text with many copies
    return written(runs.join(items, "text_key"), "hit-summary")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = SHARE, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: key, `carry`, n_words, n_hit, items, spans, contaminated.

    n_hit: words inside any occurrence of a window; items: sorted ids (as strings) of the
    items with occurring windows; spans: disjoint runs of hit words; contaminated: n_hit > 0 and share * n_hit >=
    n_words.  Null and empty texts have no words and no hits.  Items that are null or empty have no
    window, items with a null id count under no id; equal ids are one item.  Repeated rows and null keys are kept;
    empty tables give no rows or no hits; other columns are not looked at, and `carry` must not name an output.
    """
    own = pick(docs, *dict.fromkeys((key, text, *carry)))
    grams = windows(benchmark, width, item, text="text")
    summary = hit_summary(hits(own, grams, text), grams)
    rows = own.select(key, *[c for c in carry if c != key], digest(text).alias("text_key"),
                      n_words(text).alias("n_words"))
    return (rows.join(summary, "text_key", "left")
            .withColumn("n_hit", F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")))
            .withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words"))
            .select(key, *[c for c in carry if c != key], "n_words", "n_hit", "items", "spans", "contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = SHARE, spans: bool = False, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without contaminated documents; with `spans`, the others without their hit words.

    Only the digests of texts with hits are joined to the documents, and those are few unless the corpus is the benchmark.
    """
    columns = docs.columns
    grams = windows(benchmark, width)
    found = hit_summary(hits(pick(docs, text), grams, text), grams).withColumnRenamed("text_key", "_text_key")
    docs = docs.withColumn("_text_key", digest(text))
    bad = found.where(f"{share} * n_hit >= total").select("_text_key")
    docs = docs.join(bad, "_text_key", "left_anti")
    if spans:
        docs = docs.join(found.select("_text_key", F.col("spans").alias("_spans")), "_text_key", "left")
        docs = docs.withColumn(text, without_spans(text, "_spans"))
    return docs.select(*columns)


def without_spans(text: str, spans: str) -> Column:
    """The text without the words of the spans and what parts them from the next word."""
    gap = GAP[:-1]
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(^{gap}+)?{WORD}{gap}*"), F.lit(0))
    kept = F.filter(pieces, lambda x, i: ~F.exists(F.col(spans), lambda s: (s["start"] <= i) & (i < s["end"])))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) <= 0, F.col(text)).otherwise(F.array_join(kept, ""))
