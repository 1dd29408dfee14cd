"""Training, evaluation, importances and scoring on Spark ML.

The boosted-tree model is Spark's ``GBTClassificationModel`` (there is no
leaf-wise learner in Spark ML): depth, step size, row / feature subsampling,
minimum gain and round budget map one to one; leaf count and L1/L2 terms have
no counterpart.  Validation is temporal -- fit on earlier windows, evaluate on
a later one -- never a random split.

Its trees are grown by `boosting.py` with the rule of Spark's ``GBTClassifier`` (variance of the residuals of
the log loss, features drawn for each node, mean residuals in the leaves), which takes a job for each level of each tree
and begins anew for more rounds.  Here a fit of more rounds goes on from the trees that there are, and rows of
one task get a block of trees in a job.  Rows and features are drawn with other random numbers, and features of more than
`MAX_BINS` values are cut at quantiles of all rows, so trees are not those of ``GBTClassifier`` one by one.

``device_type`` is a code, not a quantity, and may have any number of values:
it is replaced by its smoothed mean label on the training windows (a small
table joined to the rows, overall mean for codes unseen there), the ordering by
which a boosted tree would sort a categorical split's values; training rows get the mean of other folds than
their own (`codes.py`).  ``maxBins`` stays fixed, so
node statistics do not grow with the number of codes.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_path
from . import boosting
from .codes import CodeMeans, code_means, with_code_means
from .features import feature_names

CATEGORICAL = "device_type"
MAX_BINS = 64
FEATURES = "features"
#: Rounds that a fit stores at once.
BLOCK = 200


@dataclass(frozen=True)
class GBTConfig:
    max_iter: int
    step_size: float
    max_depth: int
    subsampling_rate: float = 0.75
    feature_subset: str = "0.75"
    min_info_gain: float = 0.0
    min_instances_per_node: int = 1
    patience: int | None = None   # rounds without a better validation loss that end the training
    seed: int = 7
    extra: dict = field(default_factory=dict)


# The budgets of the tuning run (up to 20000 rounds, ended by 100
# rounds without improvement on the validation window) and of the final model.
TUNING = GBTConfig(max_iter=20000, step_size=0.1, max_depth=5, min_info_gain=0.001, patience=100)
FINAL = GBTConfig(max_iter=1200, step_size=0.01, max_depth=7, min_info_gain=0.01)


@dataclass(frozen=True)
class Model:
    """A fitted learner with what turns table rows into its input."""
    gbt: GBTClassificationModel
    means: CodeMeans
    features: tuple[str, ...]

    @property
    def overall(self) -> float:
        return self.means.overall

    def vectors(self, table: DataFrame) -> DataFrame:
        return _vectors(table, self.means, self.features)


def _vectors(table: DataFrame, means: CodeMeans, features: Sequence[str], trained_on: bool = False) -> DataFrame:
    inputs = ["code_mean" if f == CATEGORICAL else f for f in features]
    rows = with_code_means(table, means, F.lit(True) if trained_on else None)
    rows = VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep").transform(rows)
    label = F.col("label").cast("double") if "label" in table.columns else F.lit(None).cast("double")
    return rows.select("window_id", "user_id", label.alias("label"), FEATURES)


def _spark_learner(cfg: GBTConfig, rounds: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol="label", featuresCol=FEATURES, maxIter=rounds,
        stepSize=cfg.step_size, maxDepth=cfg.max_depth, subsamplingRate=cfg.subsampling_rate,
        featureSubsetStrategy=cfg.feature_subset, minInfoGain=cfg.min_info_gain,
        minInstancesPerNode=cfg.min_instances_per_node, maxBins=MAX_BINS, seed=cfg.seed, **cfg.extra)


class Training:
    """Training rows as vectors, with the fit of them so far."""

    def __init__(self, rows: DataFrame, features: tuple[str, ...]):
        self.rows, self.features = rows, features
        self.grown: boosting.Fit | None = None
        self._base: RDD | None = None
        self._form: tuple[GBTConfig, str] | None = None
        #: Whether fits are only asked for their losses, which need no model of Spark's.
        self.losses_only = False

    def upto(self, cfg: boosting.Config) -> boosting.Fit:
        """The fit with `cfg.rounds` trees at least; those that there are stay."""
        if self.grown is None or replace(self.grown.cfg, rounds=cfg.rounds) != cfg:
            odd = F.exists(vector_to_array(FEATURES), lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
            n, wrong = self.rows.agg(F.count(F.lit(1)), F.count_if(F.coalesce(odd | ~F.col("label").isin(0.0, 1.0), F.lit(True)))).first()
            if not n or wrong:
                raise ValueError(f"{wrong} of {n} training rows have a label other than 0 and 1 or a feature that is no finite number")
            data = _binned(self.rows, self.features)
            self._base = boosting.training_blocks(data.rows, len(self.features))
            self.grown = boosting.begin(data, data.rows, cfg, checkpoint_path(self.rows.sparkSession, f"gbt_trees_{uuid.uuid4().hex}"))
        if len(self.grown.trees) < cfg.rounds:
            self.grown = boosting.advance(self.grown, self._base, cfg.rounds, BLOCK)
        return self.grown

    def form(self, cfg: GBTConfig) -> str:
        """The saved model that the fits with these settings take their form from, made once."""
        if self._form is None or self._form[0] != cfg:
            self._form = cfg, _saved_form(_spark_learner(cfg, 1), len(self.features))
        return self._form[1]

    def done(self) -> None:
        if self._base is not None:
            self._base.unpersist()


@dataclass(frozen=True)
class Learner:
    cfg: GBTConfig
    rounds: int

    def fit(self, training: Training) -> GBTClassificationModel:
        cfg, spark_learner = self.cfg, _spark_learner(self.cfg, self.rounds)
        share = _share(cfg.feature_subset)
        if cfg.extra or share is None:  # settings that only Spark's learner knows
            return spark_learner.fit(training.rows)
        grown = training.upto(boosting.Config(
            rounds=self.rounds, step=cfg.step_size, depth=cfg.max_depth, leaves=1 << cfg.max_depth, min_gain=cfg.min_info_gain, row_share=cfg.subsampling_rate,
            feature_share=share, l1=0.0, l2=0.0, min_hessian=-1.0, min_rows=cfg.min_instances_per_node, seed=cfg.seed, means=True))
        return Losses(grown, self.rounds) if training.losses_only else _spark_model(grown, spark_learner, training.form(cfg))


@dataclass(frozen=True)
class Losses:
    """The first trees of a fit as far as stopping asks for them: loading Spark's model takes longer than growing its trees."""
    grown: boosting.Fit
    rounds: int

    def evaluateEachIteration(self, rows: DataFrame) -> list[float]:
        """The mean loss of the rows after each round, as Spark's model of the same trees has it."""
        trees, cuts, start = rows.sparkSession.sparkContext.broadcast(boosting.slim(self.grown.trees[:self.rounds])), self.grown.cuts, self.grown.start

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(len(trees.value)), 0
            for b in batches:
                for a in range(0, b.num_rows, boosting.STEP_ROWS):
                    some = b.slice(a, boosting.STEP_ROWS)
                    columns, y = boosting.by_feature(_codes(some.column(0), cuts)), 2 * some.column(1).to_numpy(zero_copy_only=False) - 1
                    for i, margin in enumerate(boosting.margins_by_round(trees.value, columns, start)):
                        total[i] += 2 * np.logaddexp(0, -2 * y * margin).sum()
                n += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["n", "total"])

        parts = rows.select(vector_to_array(FEATURES).alias("x"), "label").mapInArrow(run, "n long, total array<double>").select("n", F.posexplode("total").alias("round", "total"))
        found = [tuple(r) for r in parts.groupBy("round").agg(F.sum("total"), F.sum("n")).orderBy("round").collect()]
        if any(n and np.isnan(total) for _, total, n in found):
            raise ValueError("rows without a label have no loss")
        return [total / n if n else float("nan") for _, total, n in found] or [float("nan")] * len(trees.value)


def _share(subset: str) -> float | None:
    """The fraction of features that `subset` names, if it names one."""
    try:
        return 1.0 if subset == "all" else float(subset) if 0 < float(subset) <= 1 and "." in subset else None
    except ValueError:
        return None


def _learner(cfg: GBTConfig, rounds: int) -> Learner:
    return Learner(cfg, rounds)


def _cut_points(rows: DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Where the bins of each feature of `rows` (x, an array) end: halfway between its values, at quantiles if they are more than `MAX_BINS`."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray | None] = [np.empty(0)] * width
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i, f in enumerate(found):
                if f is not None:
                    f = np.unique(np.concatenate([f, x[:, i]]))
                    found[i] = f if len(f) <= MAX_BINS else None
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([None if f is None else f.tolist() for f in found], pa.list_(pa.float64()))],
                                         names=["place", "found"])

    some = rows.mapInArrow(values, "place int, found array<double>").groupBy("place").agg(
        F.when(F.count_if(F.col("found").isNull()) == 0, F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
    few = {r["place"]: np.unique(r["found"]) for r in some.where(f"size(found) <= {MAX_BINS}").collect()}
    many = [i for i in range(width) if i not in few]
    quantiles = boosting.cut_points(rows.select(*(F.col("x")[i].alias(f"_{i}") for i in many)), [f"_{i}" for i in many]) if many else ()
    return tuple((few[i][1:] + few[i][:-1]) / 2 if i in few else quantiles[many.index(i)] for i in range(width))


def _binned(rows: DataFrame, features: tuple[str, ...]) -> boosting.Binned:
    """The rows with a byte for each feature, as `boosting` packs them."""
    width = len(features)
    arrays = rows.select(vector_to_array(FEATURES).alias("x"), "window_id", "user_id", "label")
    cuts = _cut_points(arrays.select("x"), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = _codes(b.column(0), cuts)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(map(bytes, codes), pa.binary())], names=["window_id", "user_id", "label", "bins"])

    kinds = dict(arrays.dtypes)
    path = checkpoint_path(rows.sparkSession, f"binned_{uuid.uuid4().hex}")
    arrays.mapInArrow(run, f"window_id {kinds['window_id']}, user_id {kinds['user_id']}, label double, bins binary").write.parquet(path)
    return boosting.Binned(rows.sparkSession.read.parquet(path), features, cuts)


def _codes(x: pa.Array, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each feature of the rows (an array each)."""
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
    return np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _saved_form(learner: GBTClassifier, width: int) -> str:
    """Where this Spark has saved a model of the learner's settings and so many features."""
    spark = SparkSession.getActiveSession()
    path = checkpoint_path(spark, f"gbt_form_{uuid.uuid4().hex}")
    two = spark.createDataFrame([(float(i), Vectors.sparse(width, [])) for i in range(2)], ["label", FEATURES])
    learner.copy({learner.maxIter: 1, learner.subsamplingRate: 1.0}).fit(two).save(path)
    return path


def _spark_model(grown: boosting.Fit, learner: GBTClassifier, form: str) -> GBTClassificationModel:
    """Spark's model of the first trees, as many as the learner's rounds, by way of its saved form.

    What surrounds the trees comes from the saved model `form`.
    """
    spark, rounds = SparkSession.getActiveSession(), learner.getMaxIter()
    path = checkpoint_path(spark, f"gbt_saved_{uuid.uuid4().hex}")
    head = json.loads(spark.read.text(f"{form}/metadata").first()[0])
    head["numTrees"] = rounds
    head["paramMap"] |= {"maxIter": rounds, "subsamplingRate": learner.getSubsamplingRate()}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = spark.read.parquet(f"{form}/treesMetadata")
    tree, of, weight = trees.columns
    about = trees.first()[of]
    (spark.range(rounds).select(F.col("id").cast("int").alias(tree), F.lit(about).alias(of), F.when(F.col("id") == 0, 1.0).otherwise(learner.getStepSize()).alias(weight))
     .write.parquet(f"{path}/treesMetadata"))
    mean, leaf, n = "(-grad / greatest(n_rows, 1))", "feature < 0", "cast(n_rows as double)"
    nodes = grown.node_table(spark).where(F.col("tree") < rounds).selectExpr("tree as treeID", f"""named_struct(
        'id', node, 'prediction', {mean}, 'impurity', greatest(hess / greatest(n_rows, 1) - {mean} * {mean}, 0D), 'impurityStats', array({n}, -grad, hess),
        'rawCount', n_rows, 'gain', if({leaf}, -1D, gain), 'leftChild', low, 'rightChild', high,
        'split', named_struct('featureIndex', feature, 'leftCategoriesOrThreshold', if({leaf}, array(), array(threshold)), 'numCategories', -1)) as nodeData""")
    nodes.to(spark.read.parquet(f"{form}/data").schema).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def _training(table: DataFrame, windows: Sequence[int]):
    features = tuple(feature_names(table))
    rows = table.where(F.col("window_id").isin(list(windows)))
    means = code_means(rows, CATEGORICAL)
    return features, means, Training(_vectors(rows, means, features, trained_on=True).checkpoint(), features)


def fit(table: DataFrame, train_windows: Sequence[int], cfg: GBTConfig) -> Model:
    """Fit on ``train_windows`` with the whole budget."""
    features, means, data = _training(table, train_windows)
    gbt = _learner(cfg, cfg.max_iter).fit(data)
    data.done()
    return Model(gbt, means, features)


def best_round(losses: Sequence[float]) -> int:
    """The first round (from 1) with the least loss."""
    return min(range(len(losses)), key=losses.__getitem__) + 1


def fit_with_patience(table: DataFrame, train_windows: Sequence[int], valid_window: int, cfg: GBTConfig) -> Model:
    """Fit on ``train_windows``; the validation window's loss after each round says where to stop.

    A fit of more rounds goes on from the trees that there are, and the budget doubles until
    the best round lies ``cfg.patience`` rounds back (or ``cfg.max_iter`` is reached);
    the model is the fit of that many rounds.
    """
    features, means, data = _training(table, train_windows)
    valid = _vectors(table.where(F.col("window_id") == valid_window), means, features).checkpoint()
    rounds = min(cfg.max_iter, (cfg.patience or cfg.max_iter) + 50)
    data.losses_only = True
    while True:
        best = best_round(_learner(cfg, rounds).fit(data).evaluateEachIteration(valid))
        if rounds >= cfg.max_iter or rounds - best >= cfg.patience:
            data.losses_only = False
            gbt = _learner(cfg, best).fit(data)
            data.done()
            return Model(gbt, means, features)
        rounds = min(cfg.max_iter, 2 * rounds)


def auc(scored: DataFrame, score_col: str, windows: Sequence[int]) -> DataFrame:
    """``(window_id, auc)``: exact area under ROC (every distinct score is a point of the curve)."""
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score_col,
                                       metricName="areaUnderROC", numBins=0)
    rows = []
    for w in windows:
        part = scored.where(F.col("window_id") == w).withColumn("label", F.col("label").cast("double"))
        rows.append((int(w), float(ev.evaluate(part))))
    return scored.sparkSession.createDataFrame(rows, "window_id int, auc double")


def evaluate(model: Model, table: DataFrame, windows: Sequence[int]) -> DataFrame:
    """``(window_id, auc)`` of the model per labelled window."""
    rows = model.vectors(table.where(F.col("window_id").isin(list(windows))))
    return auc(model.gbt.transform(rows), "rawPrediction", windows)


def score(model: Model, table: DataFrame, window_id: int) -> DataFrame:
    """``(user_id, predicted_score)``: probability of activity next week."""
    out = model.gbt.transform(model.vectors(table.where(F.col("window_id") == window_id)))
    return out.select("user_id",
                      vector_to_array(F.col("probability"))[1].alias("predicted_score"))


def gain_importances(model: Model) -> DataFrame:
    """``(feature, score)`` from Spark's normalised gain importance."""
    spark = SparkSession.getActiveSession()
    imp = model.gbt.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(model.features, imp)]
    return spark.createDataFrame(rows, "feature string, score double")


def split_importances(model: Model) -> DataFrame:
    """``(feature, score)`` = number of splits on the feature over all trees
    (the boosting library's default importance).  Read from the saved model's
    node table with a Spark aggregate; features never split on score 0."""
    spark = SparkSession.getActiveSession()
    path = checkpoint_path(spark, f"gbt_model_{uuid.uuid4().hex}")
    model.gbt.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    splits = (nodes.where(F.col("nodeData.split.featureIndex") >= 0)
              .groupBy(F.col("nodeData.split.featureIndex").alias("idx"))
              .agg(F.count("*").cast("double").alias("score")))
    names = spark.createDataFrame(list(enumerate(model.features)),
                                  "idx int, feature string")
    return (names.join(F.broadcast(splits), "idx", "left")
            .select("feature", F.coalesce("score", F.lit(0.0)).alias("score")))


def param_search(table: DataFrame, train_window: int, valid_window: int,
                 base: GBTConfig, grid: dict[str, Sequence]) -> DataFrame:
    """Fit every combination of ``grid`` (GBTConfig field -> values) on the
    training window and report the validation-window AUC of each."""
    spark = table.sparkSession
    keys = sorted(grid)
    rows = []
    for combo in itertools.product(*[grid[k] for k in keys]):
        cfg = replace(base, **dict(zip(keys, combo)))
        model = fit(table, [train_window], cfg)
        auc = evaluate(model, table, [valid_window]).first()["auc"]
        rows.append((str(dict(zip(keys, combo))), float(auc)))
    return spark.createDataFrame(rows, "params string, auc double")
