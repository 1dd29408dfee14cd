"""Physical-plan properties that matter at scale."""

import math
import re
import statistics
import sys

import pytest

from dayloom.operators.popularity import author_block
from dayloom.operators.windows import STANDARD_WINDOWS
from dayloom.plans.features import feature_table
from dayloom.sources.logs import fixture_logs
from dayloom.sources.sinks import profile

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_feature_table_plan(spark):
    logs = fixture_logs(spark, SF_SMALL)
    df = feature_table(logs, STANDARD_WINDOWS, categories=list(range(12)))
    plan = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in plan, bad


def final_plan(spark, df) -> str:
    """The plan that ran, with no side small enough to broadcast by itself."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("mode", ["as_computed", "intended"])
def test_feature_table_reads_and_exchanges(spark, mode):
    """Four reads of the events (launch, creation, activity by day, items) and at most 13 exchanges."""
    plan = final_plan(spark, feature_table(fixture_logs(spark, SF_SMALL), STANDARD_WINDOWS, mode=mode, categories=list(range(12))))
    assert plan.count("events.parquet") == 4
    assert len(re.findall(r"(?<!, )Exchange hashpartitioning", plan.replace("ReusedExchange", "Reused"))) <= 13
    assert "median" not in plan


def test_only_the_wanted_blocks_are_built(spark):
    table = feature_table(fixture_logs(spark, SF_SMALL), STANDARD_WINDOWS, categories=[], columns=["video_create_avg"])
    assert _plan(table).count("events.parquet") == 1 and "label" not in table.columns


def test_day_range_reaches_the_scans(spark):
    logs = fixture_logs(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for log in (logs.launch, logs.create, logs.activity):
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", _plan(log.groupBy("user_id").count()))[1]
        assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in pushed and "LessThan(ts,2024-01-31T00:00)" in pushed


def test_profile_is_one_pass(spark):
    table = spark.range(10).selectExpr("id", "CAST(id AS DOUBLE) / 3 AS x")
    plan = _optimized(profile(table))
    assert plan.count("Range (") == 1 and "Expand" not in plan
    assert [tuple(r)[:4] for r in profile(table, ["id"]).collect()] == [("x", "double", 10, 10)]


def test_profile_values(spark):
    """Mean, deviation and quartiles against Python's, with nulls, ties, one value, none, and no rows."""
    table = spark.range(0, 1000, 1, 7).selectExpr(
        "CAST(pmod(id * 7919, 1000) AS INT) AS spread", "CASE WHEN id % 3 = 0 THEN id % 5 END AS ties",
        "CASE WHEN id = 4 THEN 2.5D END AS single", "CAST(NULL AS DOUBLE) AS none", "1e9D + id % 2 AS far")
    found = {r["feature"]: r for r in profile(table).collect()}
    for c in table.columns:
        values = sorted(r[0] for r in table.select(c).collect() if r[0] is not None)
        r, n = found[c], len(values)
        assert (r["n_rows"], r["non_null"], r["dtype"]) == (1000, n, dict(table.dtypes)[c])
        assert (r["std"] is None) == (n < 2)
        if n > 1:  # squared distances from means that are rounded to a double
            near = sys.float_info.epsilon * abs(statistics.mean(values)) / statistics.stdev(values)
            assert math.isclose(r["std"], statistics.stdev(values), rel_tol=max(near, 1e-12))
        want = [values[max(math.ceil(q * n), 1) - 1] for q in (0, 0.25, 0.5, 0.75, 1)] if n else [None] * 5
        assert [r["min"], r["q25"], r["median"], r["q75"], r["max"]] == want
        assert r["mean"] == (math.fsum(values) / n if n else None)
    empty = profile(table.where("spread < 0")).collect()
    assert sorted(r["feature"] for r in empty) == sorted(table.columns)
    assert all((r["n_rows"], r["non_null"], r["mean"], r["median"]) == (0, 0, None, None) for r in empty)


def test_profile_quartiles_stay_within_the_stated_rank_error(spark):
    """Skewed values over many partitions, with a coarse sketch: ranks off by at most n / accuracy."""
    n, accuracy = 200_000, 50
    r = profile(spark.range(0, n, 1, 16).selectExpr(f"pow(pmod(id * 7919, {n}), 3) AS x"), accuracy=accuracy).first()
    for q, c in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
        assert abs(round(r[c] ** (1 / 3)) + 1 - q * n) <= n / accuracy + 1


def test_scans_read_only_needed_columns(spark):
    logs = fixture_logs(spark, SF_SMALL)
    plan = _plan(feature_table(logs, STANDARD_WINDOWS, categories=list(range(12))))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for s in schemas:
        assert "value" not in s and "event_id" not in s and "c_name" not in s


def test_top_authors_are_broadcast_and_group_limited(spark):
    logs = fixture_logs(spark, SF_SMALL)
    plan = _plan(author_block(logs.activity, STANDARD_WINDOWS))
    assert "BroadcastExchange" in plan or "broadcast" in _optimized(
        author_block(logs.activity, STANDARD_WINDOWS)).lower()
    assert "WindowGroupLimit" in plan


def test_aggregates_are_partial(spark):
    logs = fixture_logs(spark, SF_SMALL)
    plan = _plan(feature_table(logs, STANDARD_WINDOWS, categories=list(range(12))))
    assert "partial_bit_or" in plan and "partial_count" in plan
