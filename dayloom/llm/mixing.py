"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources get word targets in proportion to their weights, none above `cap`
times its size.  A source's documents lie in up to `BLOCKS` hash blocks; each
pass (epoch) over the source takes its blocks in a permutation of its own, all
of them in whole epochs, the first ones in the last epoch until the target is
reached.  So every source has an exact quota of block draws.

The tree hands the quotas to the output shards: a node splits its draws between
the two halves of its shards, and how many of each source go left is one
multivariate hypergeometric sample, as if all draws of the node were
shuffled and cut.  A leaf then takes the next draws of each source's permuted
order (disjoint from all other shards), and a shard's rows are put in random
order locally.

Scale: one pass measures the documents; what is written for reuse is one narrow
row per document.  Sums go source block by source block, combined
map-side, so a source with a third of all rows is 4096 keys.  Windows run over one source's
blocks (at most `BLOCKS` rows an epoch) and over the one block that the target cuts.
Up to `MAX_SOURCES` sources the driver plans with one row per source.  Beyond (host names, say) it sees sums
by weight, which give the same targets, and draws by group of sources: the tree splits the draws of `GROUPS`
groups, then a task for each group splits what every shard got among its sources, by the same samples.
"""

from __future__ import annotations

import math
import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCKS = 4096
SHARDS = 64
PIECES = 16
SEED = 42
MAX_SOURCES = 100_000
GROUPS = 4096
#: Rows of the tables by source, shard or block up to which they are broadcast (under 200 bytes each).
BROADCAST_ROWS = 500_000

WORD = r"[^\\x20\\x09-\\x0D]+"


def n_words(text: str) -> Column:
    return F.expr(f"coalesce(cast(regexp_count(`{text}`, '{WORD}') as long), 0L)")


def targets(sizes: list[int], weights: list[float], cap: float) -> list[float]:
    """Shares of the total by weight, at most `cap` times a size; the excess goes to the others by weight."""
    total, capped = sum(sizes), [False] * len(sizes)
    while True:
        spent = cap * sum(s for s, c in zip(sizes, capped) if c)
        free = sum(w for w, c in zip(weights, capped) if not c)
        share = (total - spent) / free if free else 0.0
        over = [not c and w * share > cap * s for s, w, c in zip(sizes, weights, capped)]
        if not any(over):
            return [float(cap * s) if c else w * share for s, w, c in zip(sizes, weights, capped)]
        capped = [c or o for c, o in zip(capped, over)]


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` without replacement are good; inverse distribution function, outward from the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    left = rng.random()
    up = down = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    left -= up
    a = b = mode
    while left >= 0 and (a < high or b > low):
        if a < high:
            up *= (good - a) * (draws - a) / ((a + 1) * (bad - draws + a + 1))
            a += 1
            if (left := left - up) < 0:
                return a
        if b > low:
            down *= b * (bad - draws + b) / ((good - b + 1) * (draws - b + 1))
            b -= 1
            if (left := left - down) < 0:
                return b
    return mode


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each shard the number of draws of each source: the leaves of the splitting tree.

    Shards differ by at most one draw in total for each level of the tree; sums over shards are the quotas.
    """
    if shards == 1:
        return [quotas]
    half = shards // 2
    left, right = _halves(quotas, sum(quotas) * half // shards, f"{seed}/{shards}")
    return split_quotas(left, half, seed * 2 + 1) + split_quotas(right, shards - half, seed * 2 + 2)


def split_within(quotas: list[int], totals: list[int], seed: int) -> list[list[int]]:
    """The same where the draws of each shard, which sum up to those of the quotas, are given."""
    if len(totals) == 1:
        return [quotas]
    half = len(totals) // 2
    left, right = _halves(quotas, sum(totals[:half]), f"{seed}/{len(totals)}")
    return split_within(left, totals[:half], seed * 2 + 1) + split_within(right, totals[half:], seed * 2 + 2)


def _halves(quotas: list[int], room: int, seed: str) -> tuple[list[int], list[int]]:
    """`room` of all draws go left, by source; the others go right."""
    rng = random.Random(seed)
    left, rest = [], sum(quotas)
    for quota in quotas:  # a multivariate sample is a chain of conditional ones
        taken = hypergeometric(rng, quota, rest - quota, room)
        left.append(taken)
        rest -= quota
        room -= taken
    return left, [q - t for q, t in zip(quotas, left)]


def _many_goals(totals: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """The goals of any number of sources: their order by range, their shares by sums for each weight."""
    first = [F.col("_source") == "", F.col("_source")]
    placed = written(totals.orderBy(*first).withColumn("part", F.spark_partition_id()), "mix-sources")
    offsets, n = [], 0
    for r in sorted(placed.groupBy("part").count().collect()):
        offsets.append((r["part"], n))
        n += r["count"]
    offsets = F.broadcast(placed.sparkSession.createDataFrame(offsets, "part int, offset long"))
    place = F.col("offset") + F.row_number().over(Window.partitionBy("part").orderBy(*first)) - 1
    weighed = placed.join(offsets, "part").withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int")))
    weighed = written(weighed.select("_source", "words", "blocks", "weight"), "mix-weights")

    def over(share: float) -> Column:
        return F.col("weight") * F.lit(share) > F.col("words") * F.lit(cap)

    def sums(rows: DataFrame) -> dict[float, tuple[int, int]]:
        return {r["weight"]: (r["n"], r["words"]) for r in rows.groupBy("weight").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).collect()}

    every = sums(weighed)
    total = sum(words for _, words in every.values())
    capped: dict[float, tuple[int, int]] = {}
    limit = 0.0  # the share above which sources are capped; shares only grow
    while True:
        free = sum(w * (n - capped.get(w, (0, 0))[0]) for w, (n, _) in every.items())
        share = (total - cap * sum(words for _, words in capped.values())) / free if free else 0.0
        more = sums(weighed.where(over(share))) if share > limit else {}
        if sum(n for n, _ in more.values()) <= sum(n for n, _ in capped.values()):
            break
        capped, limit = more, share
    most = F.col("words") * F.lit(cap)
    return (weighed.withColumn("target", F.when(over(limit), most.cast("double")).otherwise(F.col("weight") * F.lit(share)))
            .withColumn("wanted", F.least(most, F.floor(F.col("target") + 0.5)).cast("long"))
            .selectExpr("_source", "words as source_size", "target", "if(words > 0, wanted div words, 0L) as whole",
                        "if(words > 0, wanted % words, 0L) as rest", "blocks"))


def _many_ranges(drawn: DataFrame, shards: int, seed: int) -> DataFrame:
    """For each source and shard the places of its draws, low..high - 1, with one row a group at the driver."""
    group = F.pmod(F.xxhash64(F.lit(seed), F.col("_source")), F.lit(GROUPS)).cast("int")
    counts = written(drawn.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).withColumn("_grp", group), "mix-counts")
    groups = sorted((r["_grp"], r["n"]) for r in counts.groupBy("_grp").agg(F.sum("n").alias("n")).collect())
    split = split_quotas([n for _, n in groups], shards, seed)
    totals = drawn.sparkSession.createDataFrame([(g, [row[i] for row in split]) for i, (g, _) in enumerate(groups)], "_grp int, totals array<long>")

    def ranges(own: pa.Table, total: pa.Table) -> pa.Table:
        rows = sorted(zip(own.column("_source").to_pylist(), own.column("n").to_pylist()), key=lambda r: r[0].encode("utf-8", "surrogatepass"))
        found, first = [], [0] * len(rows)
        leaves = split_within([n for _, n in rows], total.column("totals")[0].as_py(), (seed << 32) + total.column("_grp")[0].as_py() + 1) if rows else []
        for shard, row in enumerate(leaves):
            found += [(name, shard, a, a + n) for (name, _), a, n in zip(rows, first, row) if n]
            first = [a + n for a, n in zip(first, row)]
        columns = list(zip(*found)) or [()] * 4
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["_source", "shard", "low", "high"])

    return counts.groupBy("_grp").cogroup(totals.groupBy("_grp")).applyInArrow(ranges, "_source string, shard int, low long, high long")


def _block(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("_source"), F.col(key), F.col("size")), F.lit(BLOCKS)).cast("int")


def _measured(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """`docs` with its key and source columns, size, _source (never null) and _block."""
    return (docs.withColumn("size", n_words(text))
            .withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
            .withColumn("_block", _block(key, seed)))


def _plan(totals: list, weights: tuple[float, ...], cap: float) -> list[tuple] | None:
    """The goals of the sources, or None if they are too many."""
    if len(totals) > MAX_SOURCES:
        return None
    # "=..." in UTF-8 byte order is code point order; the null source, "", comes last
    totals.sort(key=lambda r: (r["_source"] == "", r["_source"].encode("utf-8", "surrogatepass")))
    sizes = [r["words"] for r in totals]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    plan = []
    for r, size, target in zip(totals, sizes, wanted):
        words = min(cap * size, math.floor(target + 0.5))
        whole, rest = divmod(words, size) if size else (0, 0)
        plan.append((r["_source"], size, target, whole, rest, r["blocks"]))
    return plan


def _ranges(drawn: DataFrame, plan: list[tuple], shards: int, seed: int) -> tuple[DataFrame, int]:
    """For each source and shard the places of its draws, low..high - 1; and the number of all draws."""
    counts = {r["_source"]: r["n"] for r in drawn.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    leaves, first = [], [0] * len(plan)
    for shard, row in enumerate(split_quotas([counts.get(p[0], 0) for p in plan], shards, seed)):
        leaves += [(p[0], shard, a, a + n) for p, a, n in zip(plan, first, row) if n]
        first = [a + n for a, n in zip(first, row)]
    ranges = drawn.sparkSession.createDataFrame(leaves, "_source string, shard int, low long, high long")
    return F.broadcast(ranges) if len(leaves) <= BROADCAST_ROWS else ranges, sum(counts.values())


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, shards: int = SHARDS, seed: int = SEED,
        key: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: key, `carry`, size, source_size, target, taken, draws.

    size: words; source_size and target: words of the row's source and what the
    mix wants of them; taken: words of this row in the mix, repeats counted, at most
    `cap` times size; draws: array<struct<epoch, shard, words>>, one entry for each time
    that words of the row are taken (its first `words` words; all but at most one draw of
    each source take whole rows).  Sources are ordered by code point, null last, and
    weigh `weights` in turn.  The taken words of a source sum up to its target, rounded.
    Equal input rows give equal output, whatever the partitioning.

    Null and empty texts have size 0 and are never taken; null sources are a
    source, null keys are kept; repeated rows count each and may differ in what is taken; an empty
    table gives an empty result; columns other than those named are not looked at, and
    `carry` must not name an output.
    """
    spark = docs.sparkSession
    own = list(dict.fromkeys((key, source, text, *carry)))
    measured = _measured(pick(docs, *own), key, text, source, seed)
    narrow = written(measured.select(key, "_source", "_block", "size"), "mix-sizes")

    blocks = narrow.groupBy("_source", "_block").agg(F.sum("size").alias("words"))
    totals = (blocks.where("words > 0").groupBy("_source").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("blocks"))
              .unionByName(narrow.select("_source").distinct().select("_source", F.lit(0).alias("words"), F.lit(0).alias("blocks")))
              .groupBy("_source").agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks")))
    plan = _plan(totals.limit(MAX_SOURCES + 1).collect(), weights, cap)
    if plan is None:
        goals = written(_many_goals(totals, weights, cap), "mix-goals")
    else:
        goals = spark.createDataFrame(plan, "_source string, source_size long, target double, whole long, rest long, blocks long")
        if len(plan) <= BROADCAST_ROWS:
            goals = F.broadcast(goals)

    # every draw of a block: whole epochs, then the first blocks of one more permutation
    order = Window.partitionBy("_source", "epoch").orderBy(
        F.xxhash64(F.lit(seed), F.col("_source"), F.col("epoch"), F.col("_block")), "_block")
    drawn = (blocks.where("words > 0").join(goals, "_source")
             .withColumn("epoch", F.explode(F.expr("sequence(0L, whole)")))
             .where("epoch < whole or rest > 0")
             .withColumn("place", F.row_number().over(order) - 1)
             .withColumn("before", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
             .where("epoch < whole or before < rest")
             .withColumn("cut", F.expr("if(epoch = whole and before + words > rest, rest - before, null)"))
             .withColumn("draw", F.expr("epoch * blocks + place")))
    drawn = written(drawn.select("_source", "_block", "epoch", "draw", "cut"), "mix-draws")

    if plan is None:
        ranges = written(_many_ranges(drawn, shards, seed), "mix-ranges")
    else:
        ranges, draws = _ranges(drawn, plan, shards, seed)
    by_block = (drawn.join(ranges, "_source").where("low <= draw and draw < high")
                .groupBy("_source", "_block")
                .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "cut"))).alias("takes"), F.max("cut").alias("cut")))
    sizes = goals.select("_source", "source_size", "target")
    if plan is None:  # with what is asked of its source in each block's row, a source with many rows meets no single key
        by_block = blocks.select("_source", "_block").join(sizes, "_source").join(by_block, ["_source", "_block"], "left")
    elif draws <= BROADCAST_ROWS:  # one row for each block, so texts that are carried stay where they are
        by_block = F.broadcast(by_block)

    rows = (measured.select(key, *[c for c in carry if c != key], "_source", "_block", "size") if carry else narrow)
    rows = rows.join(by_block, ["_source", "_block"], "left")
    # only the rows of the block that a source's target cuts need an order among themselves
    inside = Window.partitionBy("_source", "_block").orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), key, "size")
    cut = (rows.where("cut is not null")
           .withColumn("left", F.col("cut") - F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("size"))
           .withColumn("left", F.expr("greatest(0L, least(size, left))")))
    plain = rows.where("cut is null").withColumn("left", F.lit(0).cast("long"))
    take = "transform(takes, t -> struct(t.epoch as epoch, t.shard as shard, if(t.cut is null, size, left) as words))"
    rows = (plain.unionByName(cut)
            .withColumn("draws", F.expr(f"filter(coalesce({take}, array()), t -> t.words > 0)"))
            .withColumn("taken", F.expr("aggregate(draws, 0L, (n, t) -> n + t.words)")))
    return ((rows if plan is None else rows.join(sizes, "_source", "left"))
            .select(key, *[c for c in carry if c != key], "size", "source_size", "target", "taken", "draws"))


def shuffled(mixed: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The mix itself: a row for each draw (epoch, shard, words), shard by shard, in random order within a shard.

    A shard is dealt over `PIECES` partitions, so that it need not fit into one task.
    """
    drawn = mixed.withColumn("draw", F.explode("draws")).drop("draws").select("*", "draw.epoch", "draw.shard", "draw.words").drop("draw")
    return (drawn.withColumn("_order", F.xxhash64(F.lit(seed + 2), F.col("shard"), F.col("epoch"), F.col(key)))
            .withColumn("_piece", F.pmod("_order", F.lit(PIECES)))
            .repartition("shard", "_piece").sortWithinPartitions("shard", "_order").drop("_order", "_piece"))
