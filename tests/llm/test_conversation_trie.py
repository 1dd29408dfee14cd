"""The conversation trie against a brute-force one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from dayloom.llm import common, conversation_trie as ct, queries

DDL = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns by conversation; equal turns in the order of the digest of role and text."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        role, text = role or "", text or ""
        if c is not None:
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((t is not None, t or 0, digest, role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in own.items()}


def rebuilt(rows):
    own, out = ordered(rows), {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - abs(c) % 5 * (1 if c > 0 else -1), [])[:h] + said[h:]
    return out


def nodes(said):
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in said.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids[p])
    return {(min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                               hashlib.sha256(",".join(str(c) for c in sorted(m) if len(said[c]) == len(p)).encode()).hexdigest())
            for p, m in members.items()}


def found(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[2:]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("n, turns, texts, segment, shard", [
    (60, 14, ["a", "b", None, "héé"], 64, 1 << 17),
    (70, 25, ["a", "b"], 4, 8),       # shared paths over several segments, many shards
    (60, 12, ["a"], 2, 5),            # nearly all conversations are prefixes of one another
])
def test_equals_brute_force(spark, n, turns, texts, segment, shard):
    rng = random.Random(n)
    rows = [(c, t, rng.choice(["user", "bot", None]) if t else "user", rng.choice(texts))
            for c in rng.sample(range(-40, 160), n) for t in range(rng.randint(1, turns))]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    assert found(ct.prefix_trie(df, True, segment, shard)) == nodes(rebuilt(rows))
    assert found(ct.prefix_trie(df, False, segment, shard)) == nodes(ordered(rows))


def test_registered_query_equals_brute_force(spark):
    rows = [tuple(r) for r in common.table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_conversation_trie(spark, SF_SMALL)) == nodes(rebuilt(rows))


def test_awkward_rows(spark):
    rows = [(0, None, "user", None), (0, 0, None, "x"), (0, 0, None, "x"), (0, 0, "b", "x"), (None, 0, "user", "lost"), (1, 5, "", ""),
            ((1 << 63) - 3, 0, "user", "y"), (-(1 << 63), 1, "user", "z" * 100_000), (7, None, None, None), (8, 0, "a", "1:b"), (9, 0, "a1:", "b")]
    df = spark.createDataFrame([(*r, 1, "no") for r in rows], DDL + ", Text int, `ROLE` string")
    assert found(ct.prefix_trie(df, True)) == nodes(rebuilt(rows))
    assert ct.prefix_trie(df.where("false"), True).collect() == []


def test_a_conversation_of_most_turns_and_copies_of_it(spark):
    """One conversation lies in many parts of the sort; three copies share all segments."""
    long = [(5 * c, t, "user", str(t % 7)) for c in (1, 2, 3) for t in range(400)] + [(20, t, "user", str(t)) for t in range(900)]
    df = spark.createDataFrame(long, DDL).repartition(8)
    assert found(ct.prefix_trie(df, False, 100, 50)) == nodes(ordered(long))


def test_search_tree_is_balanced():
    tree = ct.SearchTree()
    for i in ct.medians(1000):
        tree.insert([i], [0])
    depth = [1] * 1000
    for i in range(1000):
        for j in (tree.low[i], tree.high[i]):
            if j >= 0:
                depth[j] = depth[i] + 1
    assert max(depth) == 10
    assert sorted(ct.medians(1000)) == list(range(1000))
