"""A mix of more sources than the driver plans one by one."""

import random

import pytest

import cases
from dayloom.llm import mixing


@pytest.mark.parametrize("n_sources,weights", [(5, mixing.WEIGHTS), (700, mixing.WEIGHTS), (90, (0.7, 400.0, 1.0, 0.01))])
def test_many_sources_are_mixed_as_few_are(spark, monkeypatch, n_sources, weights):
    rng = random.Random(n_sources)
    names = [None, "ü", "\U0001f600", "￮"] + [f"host{k}.net" for k in range(n_sources - 4)]
    rows = [(k, cases.sentences(k % 50, rng.choice([0, 1, 3, 50])), names[int(n_sources * rng.random() ** 3)]) for k in range(3000)]
    docs = cases.documents(spark, rows)
    few = {r["doc_id"]: r for r in mixing.mix(docs, weights, shards=5, carry=("source",)).collect()}
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    found = mixing.mix(docs, weights, shards=5, carry=("source",))
    out = found.collect()
    assert len(out) == len(few) == 3000
    by, shards = {}, [0] * 5
    for r in out:
        a = few[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"], r["source"]) == (a["size"], a["source_size"], a["taken"], a["source"])
        assert r["target"] == pytest.approx(a["target"], rel=1e-12)
        assert sorted((d["epoch"], d["words"]) for d in r["draws"]) == sorted((d["epoch"], d["words"]) for d in a["draws"])
        assert all(0 <= d["shard"] < 5 for d in r["draws"])
        by.setdefault(r["source"], []).append(r)
        for d in r["draws"]:
            shards[d["shard"]] += 1
    assert min(shards) > 0.7 * max(shards)
    for own in by.values():
        assert sum(r["taken"] for r in own) == min(3 * own[0]["source_size"], int(own[0]["target"] + 0.5))
    assert cases.rows_of(found) == cases.rows_of(mixing.mix(docs.repartition(7), weights, shards=5, carry=("source",)))


def test_split_within_keeps_both_margins():
    quotas, totals = [5, 0, 900, 33, 62], [100, 0, 300, 250, 350]
    leaves = mixing.split_within(quotas, totals, 9)
    assert [sum(c) for c in zip(*leaves)] == quotas and [sum(x) for x in leaves] == totals and min(map(min, leaves)) >= 0
    assert leaves == mixing.split_within(quotas, totals, 9)
    mean = sum(mixing.split_within([30, 70], [20, 80], k)[0][0] for k in range(4000)) / 4000
    assert abs(mean - 6) < 0.15
