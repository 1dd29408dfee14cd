"""Prefix trie of conversations: ternary search trees over turn ids, a range shard at a time.

Every (role, text) gets an id from a dictionary table, and a conversation becomes a sequence of ids.
Distinct sequences, with the number of their conversations, are sorted into ranges; a range is cut
into shards of at most `SHARD_TURNS` ids, and each shard becomes one ternary search tree: of its
sequences the median goes in first, then the medians of both halves, so every level is balanced.
Nodes are numbered as they are made, children after parents, so one backward walk over the numbers
adds up members, leaves and savings, and one forward walk passes depths and parents down.

Ranges are contiguous, so a trie node lies in more than one shard only if it is on the path of a shard's first or
last sequence.  Those boundary nodes leave a shard as partial sums, named by their path; one aggregate
merges the partial sums of a node, one more adds each merged node to its ancestors.

Scale: texts are read as digests only.  Positions of turns come from a range sort, so a conversation with a third
of all turns is sorted by many tasks; it is stored in rows of `SEGMENT` ids, and the trie is built segment by
segment: only conversations that still share their path with another go on to the next one, the
rest of a lone conversation is a chain that needs no tree.  Copies collapse into one row before any
range is cut; the ids of conversations that end at one node are joined part by part and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, small_batches, written

SEGMENT = 64
SHARD_TURNS = 1 << 17
#: Conversations whose ids are this far apart open alike (contract of op11), and the modulus of how many turns they share.
FAMILY, SHARED = 5, 9
NOTHING = hashlib.sha256(b"").hexdigest()

_NODE = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, shard long, at int, path array<long>, bytes long, grown boolean")
_INNER, _EDGE, _CLASS = 0, 1, 2
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# --- the tree of one shard ------------------------------------------------------------------------------------

class SearchTree:
    """A ternary search tree: `low` and `high` are other turns at the same depth, `same` is the next turn."""

    def __init__(self):
        self.symbol: list[int] = []
        self.low: list[int] = []
        self.same: list[int] = []
        self.high: list[int] = []
        self.size: list[int] = []

    def insert(self, sequence: list[int], sizes: list[int]) -> int:
        """The number of the node where the sequence ends."""
        symbol, low, same, high = self.symbol, self.low, self.same, self.high
        at, links, owner = (0 if symbol else -1), None, -1
        for x, size in zip(sequence, sizes):
            while True:
                if at < 0:
                    at = len(symbol)
                    symbol.append(x)
                    low.append(-1)
                    same.append(-1)
                    high.append(-1)
                    self.size.append(size)
                    if links is not None:
                        links[owner] = at
                    break
                if x == symbol[at]:
                    break
                links, owner = (low, at) if x < symbol[at] else (high, at)
                at = links[owner]
            end = at
            links, owner, at = same, at, same[at]
        return end


def medians(n: int) -> Iterator[int]:
    """0..n-1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            ranges += [(middle + 1, b), (a, middle)]


def shard_nodes(rows: list[dict], shard: int, first_depth: int) -> list[tuple]:
    """Rows of `_NODE` for a shard's sorted distinct sequences; the class is each path's first symbol."""
    tree = SearchTree()
    ends = {}
    for i in medians(len(rows)):
        r = rows[i]
        ends[tree.insert([r["class"], *r["seq"]], [0, *r["sizes"]])] = r
    n = len(tree.symbol)
    edges = {}  # boundary nodes, with their paths
    for r in (rows[0], rows[-1]):
        path, at = [r["class"], *r["seq"]], 0
        for k, x in enumerate(path):
            while tree.symbol[at] != x:
                at = tree.low[at] if x < tree.symbol[at] else tree.high[at]
            edges[at] = path[:k + 1]
            at = tree.same[at]
    members, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    # what a node and the nodes beside it below one parent add to that parent
    up = [(0, None, 0, 0, 0)] * (n + 1)  # the last stands for no node
    for i in range(n - 1, -1, -1):
        count, smallest, kids, tips, won = up[tree.same[i]]
        grown = tree.same[i] >= 0
        if (r := ends.get(i)) is not None:
            count += r["n"]
            smallest = r["least"] if smallest is None else min(smallest, r["least"])
            if r["sub_children"] is not None:
                kids, tips, won, grown = kids + r["sub_children"], tips + r["sub_leaves"], won + r["sub_saved"], True
        edge = i in edges
        if not edge:
            tips = tips if grown else 1
            won += (count - 1) * tree.size[i]
        members[i], least[i], children[i], leaves[i], saved[i] = count, smallest, kids, tips, won
        own = (count, smallest, 0, 0, 0) if edge else (count, smallest, 1, tips, won)
        for beside in (up[tree.low[i]], up[tree.high[i]]):
            if beside[0]:
                own = (own[0] + beside[0], min(own[1], beside[1]), own[2] + beside[2], own[3] + beside[3], own[4] + beside[4])
        up[i] = own
    given = {r["class"]: r["class_least"] for r in rows}
    parent, depth, out = [-1] * n, [0] * n, []
    for i in range(n):
        for beside in (tree.low[i], tree.high[i]):
            if beside >= 0:
                parent[beside], depth[beside] = parent[i], depth[i]
        if (below := tree.same[i]) >= 0:
            parent[below], depth[below] = i, depth[i] + 1
        if depth[i] == 0 and given[tree.symbol[i]] is not None:
            least[i] = given[tree.symbol[i]]
        r, p = ends.get(i), parent[i]
        hashed = r["ends"] if r is not None and r["ends"] is not None else None
        kind = _EDGE if i in edges else _CLASS if depth[i] == 0 and first_depth else _INNER
        grown = tree.same[i] >= 0 or r is not None and r["sub_children"] is not None
        rim = kind == _INNER and p in edges
        out.append((kind, least[i], first_depth + depth[i], None if p < 0 or p in edges else least[p], members[i], children[i], leaves[i], saved[i],
                    hashed, shard if rim or kind == _EDGE else None, i if kind == _EDGE else p if rim else None,
                    edges.get(i) if kind == _EDGE else [tree.symbol[i]] if kind == _CLASS else None, tree.size[i], grown))
    return out


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


# --- turns, ids, positions --------------------------------------------------------------------------------------

def encoded_turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, part, pos, id, bytes: the turns of every conversation in order, each with the id of its (role, text).

    Order: by turn, null first; equal turns by a digest of role and text, repeated rows stay.  Null role or text is the
    empty string.  Rows without conv_id belong to no conversation and are left out.  part: the range of the sort
    that the turn fell into; parts hold ascending ids.
    """
    small_batches(conversations.sparkSession)
    said = F.coalesce(F.col(text), F.lit(""))
    by = F.coalesce(F.col(role), F.lit(""))
    rows = (pick(conversations, key, turn, role, text).where(F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                    F.unhex(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)).alias("digest"),
                    F.octet_length(said).cast("long").alias("bytes")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("conv_id").to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            pos = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:  # the batch goes on with the conversation of the batch before
                pos[:first[1] if len(first) > 1 else len(ids)] += seen
            last, seen = ids[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("digest"), b.column("bytes"), pa.array(np.full(len(ids), part, np.int32)),
                                              pa.array(pos.astype(np.int64))], names=["conv_id", "digest", "bytes", "part", "pos"])

    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
                     .mapInArrow(numbered, "conv_id long, digest binary, bytes long, part int, pos long"), "trie-turns")
    found = sorted(placed.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"),
                                              F.max_by(F.struct("conv_id", "pos"), F.struct("conv_id", "pos")).alias("end")).collect())  # a row for each part
    ahead, open_id, open_turns = [], None, 0
    for r in found:
        before = open_turns if r["first"] == open_id else 0
        if before:
            ahead.append((r["part"], r["first"], before))
        open_turns = r["end"]["pos"] + 1 + (before if r["last"] == r["first"] else 0)
        open_id = r["last"]
    if ahead:
        ahead = F.broadcast(conversations.sparkSession.createDataFrame(ahead, "part int, conv_id long, before long"))
        placed = placed.join(ahead, ["part", "conv_id"], "left").withColumn("pos", F.col("pos") + F.coalesce("before", F.lit(0)))
    dictionary = written(placed.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    return written(placed.join(dictionary.hint("merge"), "digest").select("conv_id", "part", "pos", "id", "bytes"), "trie-encoded")


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns: one row for each conversation."""
    return turns.groupBy("conv_id").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("n_turns"))


def shared_openings(turns: DataFrame, family: int = FAMILY, modulus: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, part, n_turns) and turns (conv_id, pos, id, bytes) with openings taken from another one.

    Conversation c begins with the first h turns of conversation c - c % family (all it has, none if there is no such one) and
    goes on with its own turns after its first h; h is the unsigned CRC-32 of c in decimals, modulo `modulus`.
    c % family has the sign of c.
    """
    def shared(c: str) -> Column:
        return F.crc32(F.col(c).cast("string").cast("binary")) % modulus

    own = conversations_of(turns)
    counts = own.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    members = (own.withColumn("h", shared("conv_id")).withColumn("base", F.expr(f"conv_id - conv_id % {family}L"))
               .join(counts, "base", "left")
               .withColumn("lead", F.least("h", F.coalesce("base_turns", F.lit(0))))
               .withColumn("own_turns", F.col("n_turns"))
               .select("conv_id", "part", "h", "lead", (F.col("lead") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0))).alias("n_turns")))
    members = written(members, "trie-members")
    steps = F.array(*(F.lit(i).cast("long") for i in range(1 - family, family)))
    opening = (turns.where(f"conv_id % {family} = 0 and pos < {modulus - 1}")
               .withColumn("step", F.explode(steps)).withColumn("c", F.try_add(F.col("conv_id"), F.col("step")))
               .where(f"c is not null and c - c % {family}L = conv_id").where(F.col("pos") < shared("c"))
               .select(F.col("c").alias("conv_id"), "pos", "id", "bytes"))
    rest = turns.where(F.col("pos") >= shared("conv_id")).select("conv_id", "pos", "id", "bytes")
    joined = (opening.unionByName(rest).join(members.select("conv_id", "h", "lead").hint("merge"), "conv_id")
              .select("conv_id", F.expr("if(pos < h, pos, pos - h + lead)").alias("pos"), "id", "bytes"))
    return members.select("conv_id", "part", "n_turns"), joined


# --- the job --------------------------------------------------------------------------------------------------

def _grouped(now: DataFrame, name: str) -> DataFrame:
    """Distinct sequences of a round: class, class_least, seq, sizes, n, least, n_more, ends, node."""
    parts = (now.groupBy("class", "class_least", "seq", "sizes", "part")
             .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.count_if(~F.col("last")).alias("n_more"),
                  F.sort_array(F.collect_list(F.when(F.col("last"), F.col("conv_id")))).alias("done"))
             .withColumn("done", F.array_join(F.expr("transform(done, c -> string(c))"), ",")))
    schema = "class long, class_least long, seq array<long>, sizes array<long>, n long, least long, n_more long, ends string"

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of equal sequences, which lie together, and the digest of their members' ids, part by part."""
        key, sums, digest = None, [], None

        def row() -> tuple:
            return (*key[:2], list(key[2]), list(key[3]), *sums, None if digest is None else digest.hexdigest())

        for b in batches:
            out = []
            for r in b.to_pylist():
                own = (r["class"], r["class_least"], tuple(r["seq"]), tuple(r["sizes"]))
                if own != key:
                    if key is not None:
                        out.append(row())
                    key, sums, digest = own, [0, r["least"], 0], None
                sums = [sums[0] + r["n"], min(sums[1], r["least"]), sums[2] + r["n_more"]]
                if r["done"]:
                    if digest is None:
                        digest = hashlib.sha256()
                    else:
                        digest.update(b",")
                    digest.update(r["done"].encode())
            yield _arrow(out, schema)
        if key is not None:
            yield _arrow([row()], schema)

    summed = (parts.repartition("class", "seq").sortWithinPartitions("class", "seq", "part").mapInArrow(ends, schema))
    return written(summed.withColumn("node", F.monotonically_increasing_id() + 1), name)


def _trees(groups: DataFrame, first_depth: int, shard_turns: int) -> DataFrame:
    """The nodes of a round's trees, boundary nodes in parts."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, rows, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            for r in b.to_pylist():
                rows.append(r)
                size += len(r["seq"]) + 1
                if size >= shard_turns:
                    yield _arrow(shard_nodes(rows, (part << 32) + shard, first_depth), _NODE)
                    rows, size, shard = [], 0, shard + 1
        if rows:
            yield _arrow(shard_nodes(rows, (part << 32) + shard, first_depth), _NODE)

    return groups.repartitionByRange("class", "seq").sortWithinPartitions("class", "seq").mapInArrow(build, _NODE)


def _merged(nodes: DataFrame, first_depth: int) -> tuple[DataFrame, DataFrame]:
    """(finished nodes, class totals) of a round, boundary nodes merged."""
    edge = nodes.where(f"kind = {_EDGE}")
    whole = (edge.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
                                      F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
                                      F.max("ends_sha256").alias("ends_sha256"), F.max("bytes").alias("bytes"), F.max("grown").alias("grown"))
             .withColumn("saved_tokens", F.expr("saved_tokens + (n_convs - 1) * bytes"))
             .withColumn("n_leaves", F.expr("n_leaves + if(grown, 0, 1)")))
    whole = written(whole, "trie-edges")
    sums = (whole.withColumn("upper", F.explode(F.expr("transform(sequence(1, size(path)), k -> slice(path, 1, k))")))
            .groupBy(F.col("upper").alias("path"))
            .agg(F.sum(F.expr("case size(path) - size(upper) when 0 then n_children when 1 then 1 else 0 end")).alias("n_children"),
                 F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    above = whole.select(F.col("path").alias("upper"), F.col("conv_id").alias("parent_conv_id"))
    done = (whole.drop("n_children", "n_leaves", "saved_tokens").join(sums, "path")
            .withColumn("upper", F.expr("slice(path, 1, size(path) - 1)")).join(above, "upper", "left"))
    top = F.size("path") == 1
    rim = nodes.where(f"kind = {_INNER} and shard is not null").drop("parent_conv_id", "path")
    named = edge.select("shard", "at", "path").join(whole.select("path", F.col("conv_id").alias("parent_conv_id")), "path").drop("path")
    inner = nodes.where(f"kind = {_INNER} and shard is null")
    finished = (inner.select(*COLUMNS).unionByName(rim.join(named, ["shard", "at"]).select(*COLUMNS))
                .unionByName((done.where(~top) if first_depth else done).select(*COLUMNS)))
    totals = (nodes.where(f"kind = {_CLASS}").select(F.col("path")[0].alias("class"), "n_children", "n_leaves", "saved_tokens")
              .unionByName(done.where(top).select(F.col("path")[0].alias("class"), "n_children", "n_leaves", "saved_tokens")))
    return finished, totals.toDF("node", "sub_children", "sub_leaves", "sub_saved")


def trie(members: DataFrame, turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns: `COLUMNS`.

    members: conv_id (not null, unique), part (ranges of ascending ids), n_turns; turns: conv_id, pos (0..n_turns - 1), id, bytes.
    Conversations without turns are members of the root alone; without members there is no node.
    """
    small_batches(members.sparkSession)
    pieces = (turns.withColumn("k", F.expr(f"pos div {segment}")).groupBy("conv_id", "k")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "bytes"))).alias("t"))
              .select("conv_id", "k", F.col("t.id").alias("seq"), F.col("t.bytes").alias("sizes")))
    pieces = written(pieces, "trie-segments")
    none = F.expr("cast(array() as array<long>)")
    now = (members.join(pieces.where("k = 0").drop("k"), "conv_id", "left")
           .select("conv_id", "part", "n_turns", F.lit(0).cast("long").alias("class"), F.lit(None).cast("long").alias("class_least"),
                   F.coalesce("seq", none).alias("seq"), F.coalesce("sizes", none).alias("sizes"), (F.col("n_turns") <= segment).alias("last")))
    rounds, chains, k = [], [], 0
    while True:
        now = written(now, f"trie-round-{k}")
        groups = _grouped(now, f"trie-groups-{k}")
        rounds.append(groups)
        if groups.where("n_more > 0").isEmpty():
            break
        going = (now.where("not last").select("conv_id", "part", "n_turns", "class", "seq")
                 .join(groups.where("n_more > 0").select("class", "seq", "n", "least", "node").hint("merge"), ["class", "seq"]))
        going = written(going.drop("class", "seq"), f"trie-going-{k}")
        chains.append(going.where("n = 1").join(pieces.where(f"k > {k}"), "conv_id")
                      .select("conv_id", "n_turns", F.col("k").alias("at"), F.posexplode("seq"))
                      .withColumn("depth", F.expr(f"at * {segment} + pos + 1"))
                      .select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).alias("n_convs"),
                              F.when(F.col("depth") < F.col("n_turns"), 1).otherwise(0).alias("n_children"), F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens"),
                              F.sha2(F.when(F.col("depth") < F.col("n_turns"), "").otherwise(F.col("conv_id").cast("string")), 256).alias("ends_sha256")))
        k += 1
        now = (going.where("n > 1").join(pieces.where(f"k = {k}").drop("k"), "conv_id")
               .select("conv_id", "part", "n_turns", F.col("node").alias("class"), F.col("least").alias("class_least"), "seq", "sizes",
                       (F.col("n_turns") <= (k + 1) * segment).alias("last")))
    below, found = None, []
    for k in range(len(rounds) - 1, -1, -1):
        groups = rounds[k]
        if below is None:
            groups = groups.select("*", *(F.lit(None).cast("long").alias(c) for c in ("sub_children", "sub_leaves", "sub_saved")))
        else:
            groups = groups.join(below, "node", "left")
        lone = F.col("n_more").eqNullSafe(F.lit(1)) & (F.col("n") == 1)  # a chain hangs below: one child, one leaf, no savings
        for c, x in (("sub_children", 1), ("sub_leaves", 1), ("sub_saved", 0)):
            groups = groups.withColumn(c, F.when(lone, F.lit(x).cast("long")).otherwise(F.col(c)))
        nodes = written(_trees(groups, k * segment, shard_turns), f"trie-nodes-{k}")
        finished, below = _merged(nodes, k * segment)
        found.append(finished)
    every = reduce(DataFrame.unionByName, [*found, *chains])
    return every.select("conv_id", "depth", "parent_conv_id", *(F.col(c).cast("long").alias(c) for c in COLUMNS[3:7]),
                        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, openings: bool = False, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS,
                key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of conversations, one row per node; with `openings`, of conversations rebuilt by `shared_openings`.

    conv_id: the node's smallest member; depth: turns from the root (0); parent_conv_id: smallest member of the parent, null for
    the root; n_convs: conversations that begin with the node's turns; n_children; n_leaves: childless nodes below it, or itself; saved_tokens:
    over its subtree, (n_convs - 1) times the bytes of the node's last text; ends_sha256: of the ids that end here,
    ascending, comma-joined.

    Null role or text is empty; null turns come first; equal turns are ordered by a digest of role and text, and repeated rows are repeated turns;
    rows without conv_id are left out.  Texts of any length count as they are.  An empty table gives an empty
    result; other columns are not looked at.
    """
    turns = encoded_turns(conversations, key, turn, role, text)
    members, turns = shared_openings(turns) if openings else (conversations_of(turns), turns.drop("part"))
    return trie(members, turns, segment, shard_turns)
