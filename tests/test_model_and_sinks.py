import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dayloom.operators.windows import STANDARD_WINDOWS
from dayloom.plans import model as m
from dayloom.plans.features import feature_table
from dayloom.plans.queries import rounded
from dayloom.session import checkpoint_path
from dayloom.sources import sinks
from dayloom.sources.logs import fixture_logs, read_parquet_logs, write_parquet_logs

from conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def table(spark):
    return feature_table(fixture_logs(spark, SF_CHECK), STANDARD_WINDOWS).checkpoint(eager=True)


def test_patience(table, monkeypatch):
    """The budget doubles until the best round lies `patience` rounds back; the model is the fit of that many rounds."""
    losses, asked = [1.0, .9, .8, .7, .75, .76] + [.8] * 100, []

    class Fit:
        def __init__(self, rounds):
            self.rounds = rounds

        def evaluateEachIteration(self, _):
            return losses[:self.rounds]

    class Learner:
        def __init__(self, rounds):
            self.rounds = rounds

        def fit(self, _):
            asked.append(self.rounds)
            return Fit(self.rounds)

    monkeypatch.setattr(m, "_learner", lambda cfg, rounds: Learner(rounds))
    few = table.select("window_id", "user_id", "device_type", "video_operate_times", "label").where("window_id < 3")
    model = m.fit_with_patience(few, [1], 2, replace(m.TUNING, patience=3))
    assert asked == [53, 4] and model.gbt.rounds == 4
    asked.clear()
    losses[60] = 0.1
    model = m.fit_with_patience(few, [1], 2, replace(m.TUNING, patience=3))
    assert asked == [53, 4] and model.gbt.rounds == 4  # stopped before it could see round 61, as patience does
    asked.clear()
    losses[51] = 0.2
    model = m.fit_with_patience(few, [1], 2, replace(m.TUNING, patience=3, max_iter=70))
    assert asked == [53, 70, 61] and model.gbt.rounds == 61


def test_more_rounds_begin_with_the_same_trees(table):
    few = table.where("window_id < 3")
    a = m.fit(few, [1], replace(m.TUNING, max_iter=2))
    b = m.fit(few, [1], replace(m.TUNING, max_iter=4))
    assert [t.toDebugString.split("\n", 1)[1] for t in a.gbt.trees] == [t.toDebugString.split("\n", 1)[1] for t in b.gbt.trees[:2]]


def test_temporal_validation_auc(table):
    mdl = m.fit(table, [1], replace(m.TUNING, max_iter=15))
    auc = {r.window_id: r.auc for r in m.evaluate(mdl, table, [1, 2]).collect()}
    assert auc[1] > 0.5 and auc[2] > 0.5


def test_auc_is_exact(spark):
    import random
    rng = random.Random(1)
    rows = [(1, rng.randint(0, 1), rng.choice([0.1, 0.2, 0.2, 0.7]) + rng.random() // 1.5) for _ in range(3000)]
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    exact = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = m.auc(spark.createDataFrame(rows, "window_id int, label int, s double"), "s", [1]).first()["auc"]
    assert abs(got - exact) < 1e-9


def test_unseen_device_codes_take_the_overall_mean(spark, table):
    mdl = m.fit(table, [1], replace(m.TUNING, max_iter=1))
    other = table.where("window_id = 2").withColumn("device_type", F.lit(-5))
    at = mdl.features.index("device_type")
    assert {r.features[at] for r in mdl.vectors(other).select("features").distinct().limit(3).collect()} == {mdl.overall}
    assert mdl.gbt.getMaxBins() == m.MAX_BINS


def test_the_same_stages_at_every_size(spark):
    """Nothing about the learner depends on the number of rows."""
    small = feature_table(fixture_logs(spark, SF_SMALL), STANDARD_WINDOWS)
    big = feature_table(fixture_logs(spark, SF_CHECK), STANDARD_WINDOWS)
    a, b = (m.fit(t, [1], replace(m.TUNING, max_iter=1)) for t in (small, big))
    params = [{p.name: v for p, v in x.gbt.extractParamMap().items()} for x in (a, b)]
    assert params[0] == params[1] and a.features == b.features


def test_scores_one_per_user_in_unit_interval(spark, table):
    mdl = m.fit(table, [1, 2], replace(m.FINAL, max_iter=5))
    out = checkpoint_path(spark, f"scores_{uuid.uuid4().hex}")
    sinks.write_scores(m.score(mdl, table, 3), out)
    agg = sinks.read_scores(spark, out).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u"),
                                            F.min("predicted_score").alias("lo"), F.max("predicted_score").alias("hi")).first()
    assert agg.n == agg.u == table.where("window_id = 3").count()
    assert 0.0 <= agg.lo <= agg.hi <= 1.0


def test_importances(spark, table):
    mdl = m.fit(table, [1], replace(m.TUNING, max_iter=5))
    split_rows = m.split_importances(mdl).collect()
    assert len(split_rows) == len([c for c in table.columns if c not in ("window_id", "user_id", "label")])
    assert sum(r.score for r in split_rows) > 0
    gain = m.gain_importances(mdl).collect()
    assert abs(sum(r.score for r in gain) - 1.0) < 1e-6
    out = checkpoint_path(spark, f"imp_{uuid.uuid4().hex}")
    sinks.write_importances(m.split_importances(mdl), out)
    scores = [r.score for r in sinks.read_importances(spark, out).collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) == len(split_rows)


def test_param_search(table):
    res = m.param_search(table, 1, 2, replace(m.TUNING, max_iter=3), {"max_depth": [2, 3]}).collect()
    assert len(res) == 2 and all(0 <= r.auc <= 1 for r in res)


def test_parquet_logs_prune_by_day(spark):
    logs = fixture_logs(spark, SF_SMALL)
    root = checkpoint_path(spark, f"logs_{uuid.uuid4().hex}")
    write_parquet_logs(logs, root)
    stored = read_parquet_logs(spark, root)
    assert stored.activity.count() == logs.activity.count()
    df = feature_table(stored, [STANDARD_WINDOWS[0]], categories=list(range(12)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    a = rounded(feature_table(logs, [STANDARD_WINDOWS[0]], categories=list(range(12))))
    b = rounded(df)   # variance sums run in another order: compare at 6 decimals
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tsv_reader(spark, tmp_path):
    p = tmp_path / "launch.txt"
    p.write_text("1\t3\n2\t16\n")
    from dayloom.sources.logs import read_tsv
    from dayloom.sources.schemas import LAUNCH
    rows = read_tsv(spark, str(p), LAUNCH).collect()
    assert [(r.user_id, r.day) for r in rows] == [(1, 3), (2, 16)]
