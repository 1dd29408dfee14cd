"""Trees grown in blocks against Spark's own learner, continuing, and the form that Spark loads."""

import random
from dataclasses import replace

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from dayloom.plans import boosting as b, model as m

CFG = replace(m.TUNING, max_iter=12, subsampling_rate=1.0, feature_subset="all")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for u in range(400):
        x = [float(rng.randrange(k)) for k in (2, 7, 40, 60)] + [rng.choice([0.25, -1.5, 8.0]), 3.0]
        out.append((1, u, float(x[1] + x[2] / 9 + rng.gauss(0, 2) > 5), Vectors.dense(x)))
    return spark.createDataFrame(out, ["window_id", "user_id", "label", m.FEATURES]).repartition(3).checkpoint()


def test_without_draws_the_trees_are_those_of_sparks_learner(rows):
    spark_own = m._spark_learner(CFG, 12).fit(rows)
    own = m._learner(CFG, 12).fit(m.Training(rows, tuple("abcdef")))
    assert own.evaluateEachIteration(rows) == pytest.approx(spark_own.evaluateEachIteration(rows), rel=1e-9)
    assert own.featureImportances.toArray() == pytest.approx(spark_own.featureImportances.toArray(), abs=0.03)  # (of equal gains either feature)
    assert own.treeWeights == spark_own.treeWeights and own.getNumTrees == 12 and own.numFeatures == 6
    params = [{p.name: v for p, v in x.extractParamMap().items()} for x in (own, spark_own)]
    assert params[0] == params[1]
    a, c = (x.transform(rows).select("user_id", "probability").orderBy("user_id").collect() for x in (own, spark_own))
    assert all(list(p.probability) == pytest.approx(list(q.probability), rel=1e-9) for p, q in zip(a, c, strict=True))


def test_more_rounds_go_on_from_the_trees_that_there_are(rows, monkeypatch):
    """A fit of more rounds grew all of them anew, and one more fit gave the best round's model."""
    grown, grow = [], b.advance
    monkeypatch.setattr(b, "advance", lambda fit, *a: (grown.append(-len(fit.trees)), grow(fit, *a), grown.append(len(fit.trees)))[1])
    cfg, training = replace(m.TUNING, max_iter=9), m.Training(rows, tuple("abcdef"))
    a, c, e = (m._learner(cfg, n).fit(training) for n in (4, 9, 6))
    assert grown == [0, 4, -4, 9]
    at_once = m._learner(cfg, 9).fit(m.Training(rows, tuple("abcdef")))
    assert [x.getNumTrees for x in (a, c, e)] == [4, 9, 6]
    curve = at_once.evaluateEachIteration(rows)
    assert all(x.evaluateEachIteration(rows) == pytest.approx(curve[:n]) for x, n in ((a, 4), (c, 9), (e, 6)))


def test_losses_need_no_model_of_sparks(rows, monkeypatch):
    """Each doubled budget had Spark load a model of all its trees, only to ask for the losses."""
    cfg, training = replace(m.TUNING, max_iter=9), m.Training(rows, tuple("abcdef"))
    curve = m._learner(cfg, 9).fit(training).evaluateEachIteration(rows)
    training.losses_only = True
    monkeypatch.setattr(m, "_spark_model", lambda *a: pytest.fail("a model was loaded"))
    for n in (4, 9):
        assert m._learner(cfg, n).fit(training).evaluateEachIteration(rows) == pytest.approx(curve[:n], rel=1e-9)
    few = m._learner(cfg, 4).fit(training)
    assert all(x != x for x in few.evaluateEachIteration(rows.where("label > 1")))
    with pytest.raises(ValueError):
        few.evaluateEachIteration(rows.withColumn("label", F.when(F.col("user_id") != 3, F.col("label"))))


def test_rows_of_many_tasks_give_the_same_trees(rows, monkeypatch):
    one = m._learner(CFG, 4).fit(m.Training(rows, tuple("abcdef")))
    monkeypatch.setattr(b, "TASK_BYTES", 0)
    monkeypatch.setattr(b, "BLOCK_ROWS", 100)
    training = m.Training(rows, tuple("abcdef"))
    many = m._learner(CFG, 4).fit(training)
    assert training._base.getNumPartitions() > 1
    assert many.evaluateEachIteration(rows) == pytest.approx(one.evaluateEachIteration(rows))


@pytest.mark.parametrize("odd", ["label = 2", "label = null", "features = null"])
def test_odd_rows_fail_as_with_sparks_learner(spark, rows, odd):
    column, _, value = odd.partition(" = ")
    bad = rows.withColumn(column, F.when(F.col("user_id") == 3, F.expr(value)).otherwise(F.col(column)))
    for learner, data in ((m._spark_learner(CFG, 1), bad), (m._learner(CFG, 1), m.Training(bad, tuple("abcdef")))):
        with pytest.raises(Exception):
            learner.fit(data)
