"""The splitting tree as it shows in the mix: who goes to which shard, and how much."""

from collections import Counter

from pyspark.sql import functions as F

import cases
from conftest import SF_SMALL
from dayloom.llm import common, mixing, queries


def test_draws_of_the_query_are_the_leaves_of_the_tree(spark):
    """Distinct block draws by source and shard are the leaves, exactly; words of draws add up to what is taken."""
    docs = common.table(spark, SF_SMALL, "documents")
    found = queries.op8_mixing(spark, SF_SMALL)
    blocks = mixing._measured(docs.select("doc_id", "text", "source"), "doc_id", "text", "source", mixing.SEED).select("doc_id", "_source", "_block")
    rows = found.join(blocks, "doc_id").collect()
    assert len(rows) == docs.count()
    seen, words = set(), Counter()
    for r in rows:
        draws = [tuple(map(int, d.split(":"))) for d in r["draws"].split(",") if d]
        assert sum(w for _, _, w in draws) == r["taken"] and all(0 < w <= r["size"] for _, _, w in draws)
        assert sorted(e for e, _, _ in draws) == list(range(len(draws)))
        for epoch, shard, n in draws:
            seen.add((r["_source"], r["_block"], epoch, shard))
            words[shard] += n
    assert len(seen) == len({x[:3] for x in seen})  # a draw of a block lies in one shard
    leaves = Counter((source, shard) for source, _, _, shard in seen)
    sources = sorted({x[0] for x in seen} | {r["_source"] for r in rows}, key=lambda s: (s == "", s.encode()))
    quotas = [sum(leaves[s, k] for k in range(mixing.SHARDS)) for s in sources]
    tree = mixing.split_quotas(quotas, mixing.SHARDS, mixing.SEED)
    assert [[leaves[s, k] for s in sources] for k in range(mixing.SHARDS)] == tree
    assert max(map(sum, tree)) - min(map(sum, tree)) <= 7
    assert set(words) <= set(range(mixing.SHARDS)) and len(words) > mixing.SHARDS // 2


def test_documents_without_words_have_no_draws(spark):
    docs = cases.documents(spark, [(1, None, "a"), (2, "", "a"), (3, "one two three", "a"), (4, "   ", None)])
    out = {r["doc_id"]: r for r in mixing.mix(docs).select("doc_id", "taken", F.size("draws").alias("n")).collect()}
    assert all(out[k]["taken"] == 0 and out[k]["n"] == 0 for k in (1, 2, 4)) and out[3]["n"] >= 1
