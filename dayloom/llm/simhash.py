"""SimHash near-dedup with pigeonring filtering.

A fingerprint is cut into `SEGMENTS` segments on a ring.  If two fingerprints
differ in at most t bits, then from some segment on every chain of l
consecutive segments differs in at most floor(l * t / SEGMENTS) bits.  Pairs meet in
an equi-join on the first segments of such a chain: one side emits the chain's
bits as they are, the other also those with the flips that the chain's budgets
allow.  What meets is checked chain by chain and only then by its full
Hamming distance, all inside the join condition, so the join puts out links alone.

The chain in the key is as long as it takes to keep the expected number of strangers
with an equal key below one in `SPARSE`; every length is lossless, it only moves work
from comparing to emitting.

Scale: fingerprints are a narrow map.  Copies collapse into distinct fingerprints
(partial aggregation) before anything is emitted or compared, so a group of copies of
any size is one row.  Components come from rounds of large-star and small-star over the
links, checkpointed in the shared folder; nothing is collected.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts, pick, shared_dir, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SPARSE = 64
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64 bits, unsigned; 0 for texts without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(width))) if len(words) >= width else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, digest (of the text), fp (the fingerprint as a signed long), one row per row of `docs`."""
    def run(texts: list[str | None]) -> list[list]:
        return [np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64)]

    return map_texts(pick(docs, key, text).withColumn("digest", _digest(text)), (key, "digest"), text, "fp long", lambda: run)


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def budgets(segments: int, most: int) -> list[int]:
    """Bits that a chain of 1, 2, ... segments may differ in."""
    return [n * most // segments for n in range(1, segments + 1)]


def ring_size(most: int) -> int:
    return next(m for m in (8, 16, 32, 64) if m > 2 * most or m == 64)


def key_masks(segments: int, most: int, length: int) -> list[int]:
    """Flips within the first `length` segments (the highest bits) that the chain's budgets allow."""
    width, allowed = 64 // segments, budgets(segments, most)
    bits = range(width * length)  # counted from the highest
    return [sum(1 << (63 - b) for b in flips) for n in range(allowed[length - 1] + 1) for flips in combinations(bits, n)
            if all(sum(b < width * (i + 1) for b in flips) <= allowed[i] for i in range(length))]


def _rotated(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(nodes: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Pairs a < b of the distinct longs in `nodes.fp` that differ in 1 to `most` bits."""
    m = ring_size(most)
    width, allowed, count = 64 // m, budgets(m, most), nodes.count()
    length = next((n for n in range(1, m) if 1 << (width * n) >= SPARSE * count and 1 << (width * n) >= 1 << 16), m - 1)
    # no longer than the flips stay few: beyond that the emitted rows outweigh what they save
    while length > 1 and len(key_masks(m, most, length)) > 64:
        length -= 1
    masks = key_masks(m, most, length)
    room = 64 - width * length

    def keyed(flips: list[int]) -> Column:
        """A row for each start s of the ring and each flip: the bits k of the chain from there."""
        return F.inline(F.array(*(
            F.struct(F.lit(s).alias("s"),
                     F.shiftrightunsigned(_rotated(F.col("fp"), width * s).bitwiseXOR(F.lit(_signed(f))), room).alias("k"))
            for s in range(m) for f in flips)))

    plain = nodes.select(F.col("fp").alias("a"), keyed([0]))
    varied = nodes.select(F.col("fp").alias("b"), keyed(masks))
    # hinted: the optimizer takes a side's size from before its rows are multiplied, and would broadcast it
    differ = "(a ^ b)"
    turned = f"(shiftleft({differ}, {width} * s) | if(s = 0, 0L, shiftrightunsigned({differ}, 64 - {width} * s)))"
    chain = " and ".join(f"bit_count(shiftrightunsigned({turned}, {64 - width * (i + 1)})) <= {allowed[i]}" for i in range(m - 1))
    return (plain.join(varied.hint("merge"), ["s", "k"])
            .where(f"a <> b and {chain} and bit_count({differ}) <= {most}")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the component's smallest node) of all nodes in `edges` (a, b).

    Alternating large-star and small-star steps, O(log^2 n) rounds; each round's edges are
    checkpointed, and a count and a checksum tell when they stay.
    """
    shared_dir(edges.sparkSession)

    def star(pairs: DataFrame) -> DataFrame:
        """u with its least neighbour or itself."""
        return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))

    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    before = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(star(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        mins = star(large)
        small = (large.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(mins.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        now = small.checkpoint()
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(found: DataFrame, most: int) -> DataFrame:
    """fp, root: the component of each distinct fingerprint in `found`, named by one of its fingerprints."""
    nodes = found.select("fp").distinct()
    if most <= 0:
        return nodes.withColumn("root", F.col("fp"))
    joined = components(links(nodes, most))
    return nodes.join(joined, nodes["fp"] == joined["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, most: int = MAX_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, fp, component_id (smallest key reachable over links of up to `most` bits).

    Texts without words (null, empty, white space) have the fingerprint 0 and
    link like any other.  Texts with fewer than `width` words hash whole.  Equal
    fingerprints always share a component, so exact copies and repeated rows do.  Null keys are kept and never
    chosen as component_id unless a component has no other.  An empty table gives an
    empty result; other columns are not looked at.
    """
    found = written(fingerprints(docs, width, key, text), "simhash")
    least = found.groupBy("fp").agg(F.min(key).alias("least"))
    labelled = classes(found, most).join(least, "fp")
    roots = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.join(labelled.join(roots, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE, most: int = MAX_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that stay when each component keeps one document.

    The smallest key stays (null keys only where there is no other), of its texts the one with the least digest, of
    equal rows any one.  Texts travel once, by key and digest, so no group of copies meets in a task.
    """
    found = written(fingerprints(docs, width, key, text), "simhash")
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "digest")).alias("first")
    by_fp = found.groupBy("fp").agg(first)
    stay = (classes(found, most).join(by_fp, "fp").groupBy("root").agg(F.min("first").alias("first"))
            .select(_named(F.col("first.key")).alias("_key"), F.col("first.digest").alias("_digest")))
    columns = docs.columns
    return (docs.withColumn("_key", _named(F.col(key))).withColumn("_digest", _digest(text))
            .join(stay, ["_key", "_digest"]).dropDuplicates(["_key", "_digest"]).select(*columns))


def _named(key: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def hex_fingerprint(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
