import random

from pyspark.sql import functions as F

from dayloom.functions import daysets as ds
from dayloom.functions.weights import CUMULATIVE_WEIGHTS, step_weight_value


def _brute(days):
    s = sorted(days)
    g = [b - a for a, b in zip(s, s[1:])]
    return {
        "n": len(s), "first": s[0] if s else None, "last": s[-1] if s else None,
        "gmax": max(g) if g else None, "gmin": min(g) if g else None,
        "gmean": (sum(g) / len(g)) if g else None,
        "sw": sum(step_weight_value(d) for d in s),
        "cw": sum(CUMULATIVE_WEIGHTS[d] for d in s),
        "cyc": 16 in s and 9 in s,
        "any": any(d in s and d - 7 in s for d in range(7, 17)),
    }


def test_bitmap_helpers_against_brute_force(spark):
    rnd = random.Random(3)
    sets = [set(), {16}, {1}, {1, 16}, {9, 16}, {2, 9, 9, 16}] + \
        [set(rnd.sample(range(1, 17), rnd.randint(0, 16))) for _ in range(60)]
    rows = [(i, sum(1 << d for d in s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "i int, m long")
    m = "m"
    out = df.select("i", ds.count_days(m).alias("n"), ds.first_day(m).alias("first"),
                    ds.last_day(m).alias("last"), ds.gap_max(m).alias("gmax"),
                    ds.gap_min(m).alias("gmin"), ds.gap_mean(m).alias("gmean"),
                    ds.step_weight_sum(m).alias("sw"), ds.cumulative_weight_sum(m).alias("cw"),
                    ds.weekly_pair(m, 16).alias("cyc"),
                    ds.any_weekly_pair(m, 7, 16).alias("any")).collect()
    for r in out:
        b = _brute(sets[r.i])
        assert r.n == b["n"]
        assert r.first == b["first"] and r.last == b["last"]
        assert r.gmax == b["gmax"] and r.gmin == b["gmin"]
        assert (r.gmean is None and b["gmean"] is None) or abs(r.gmean - b["gmean"]) < 1e-12
        assert r.sw == b["sw"] and r.cw == b["cw"]
        assert bool(r.cyc) == b["cyc"] and bool(r.any) == b["any"]


def test_day_bit_aggregate(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 16), (2, 1)], "u long, d int")
    got = {r.u: r.m for r in df.groupBy("u").agg(F.bit_or(ds.day_bit(F.col("d"))).alias("m")).collect()}
    assert got == {1: (1 << 3) | (1 << 16), 2: 1 << 1}
