"""Named queries over the benchmark tables (the registry behind
``__spark_entry__``).  Each takes ``(spark, sf_dir)``, reads the fixture logs
derived from ``customer`` / ``events`` and returns a DataFrame; doubles are
rounded to 6 decimals so results compare across engines.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import daysets as ds
from ..functions.weights import CURRENT_DAY, FEATURE_DAYS, HORIZONS
from ..operators import activity as act
from ..operators import creation as cre
from ..operators import launch as lau
from ..operators import popularity as pop
from ..operators.affinity import video_affinity
from ..operators.label import any_log_labels, launch_labels
from ..operators.recurrence import flagged_users
from ..operators.spine import duplicate_users, register_type_categories, user_spine
from ..operators.windows import STANDARD_WINDOWS, FeatureWindow, assign_windows, day_span, in_span, window
from ..session import checkpoint_path
from ..sources.logs import fixture_logs, read_parquet_logs, read_tsv_logs, write_parquet_logs, write_tsv_logs
from ..sources.sinks import (profile, read_feature_csv, read_feature_table, read_importances, read_scores,
                             write_feature_csv, write_feature_table, write_importances, write_scores)
from .features import KEYS, feature_table
from .rollup import add_days, bucketed, launches_of_stored_windows, read_day_counts, store_windows

W = STANDARD_WINDOWS


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded half-even to ``digits`` decimals with plain double
    arithmetic, ``rint(x * 10^d) / 10^d``: codegen'd, doubles throughout (no
    long in between, so large values and NaN survive), and the SQL oracle
    applies the same IEEE operations, so both engines agree bit for bit on
    equal inputs (a decimal round trip costs far more per value)."""
    scale = f"{float(10 ** digits)!r}D"
    cols = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(f"rint({name} * {scale}) / {scale} AS {name}")
        else:
            cols.append(name)
    return df.selectExpr(*cols)


def _logs(spark, sf_dir):
    return fixture_logs(spark, sf_dir)


# --- spine -------------------------------------------------------------------

def register_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    return rounded(user_spine(logs.register, W, register_type_categories(logs.register)))


def register_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uniqueness check on a log that fails it: one registration per order."""
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet"))
    return duplicate_users(orders.select(F.col("o_custkey").cast("long").alias("user_id")))


# --- launch ------------------------------------------------------------------

def launch_daily_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct launch days per user and window: de-duplicated per (user, day)
    first -- each raw row once -- then tagged with the windows of the day."""
    launch = _logs(spark, sf_dir).launch
    days = launch.where(in_span(W)).select("user_id", "day").distinct()
    return assign_windows(days, W).select("window_id", "user_id", "wday")


def _launch_active(spark, sf_dir):
    sets = lau.launch_day_sets(_logs(spark, sf_dir).launch, W, with_label_days=False)
    return sets.where(F.col("launch_days") != 0)


def launch_recency_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = "launch_days"
    return rounded(_launch_active(spark, sf_dir).select(
        *KEYS,
        (F.lit(CURRENT_DAY) - ds.last_day(days)).cast("int").alias("user_launch_last_day_distance"),
        ds.cumulative_weight_sum(days).alias("user_launch_date_occupied"),
        ds.step_weight_sum(days).alias("launch_step_weight"),
        ds.count_days(days).alias("launch_days")))


def _gap_columns(days, prefix):
    return [ds.gap_max(days).cast("double").alias(f"{prefix}_max"),
            ds.gap_min(days).cast("double").alias(f"{prefix}_min"),
            ds.gap_mean(days).cast("double").alias(f"{prefix}_mean")]


def launch_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_launch_active(spark, sf_dir).select(
        *KEYS, *_gap_columns("launch_days", "diff_day")))


def horizon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = "launch_days"
    return _launch_active(spark, sf_dir).select(
        *KEYS, *[ds.count_days(days, CURRENT_DAY - i, FEATURE_DAYS)
                 .alias(f"app_launch{i}_day_before_rate") for i in HORIZONS])


# --- creation ----------------------------------------------------------------

def create_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = cre.creation_block(_logs(spark, sf_dir).create, W)
    return rounded(block.select(*KEYS, *_gap_columns("create_days", "create_video_diff_day")))


def create_day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = cre.creation_block(_logs(spark, sf_dir).create, W)
    days = "create_days"
    return rounded(block.select(
        *KEYS,
        F.col("create_rows").alias("video_create_times"),
        ds.count_days(days).alias("day_num_create_video"),
        F.col("create_day_max").alias("user_video_create_day_max"),
        F.col("create_day_min").alias("user_video_create_day_min"),
        (F.col("create_rows") / ds.count_days(days)).alias("user_video_create_day_mean"),
        (F.lit(CURRENT_DAY) - ds.last_day(days)).cast("int")
        .alias("user_video_create_latest_day_distance"),
        F.col("create_latest_n").alias("user_video_create_latest_day_num"),
        ds.step_weight_sum(days).alias("user_video_create_day_occupy"),
        F.col("create_weighted_rows").alias("weight_create_count")))


# --- activity ----------------------------------------------------------------

def activity_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(act.activity_row_gaps(_logs(spark, sf_dir).activity, W))


def activity_day_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = act.activity_block(_logs(spark, sf_dir).activity, W)
    days = "act_days"
    return rounded(block.select(
        *KEYS,
        F.col("act_rows").alias("video_operate_times"),
        ds.count_days(days).alias("user_operate_video_day_num"),
        F.col("act_max").alias("user_operate_video_day_max"),
        F.col("act_min").alias("user_operate_video_day_min"),
        (F.col("act_rows") / ds.count_days(days)).alias("user_operate_video_day_mean"),
        F.col("act_median").alias("user_operate_video_day_median"),
        F.sqrt("act_var").alias("user_operate_video_day_std"),
        F.col("act_var").alias("user_operate_video_day_var"),
        (F.lit(CURRENT_DAY) - ds.last_day(days)).cast("int").alias("operate_video_distance_day"),
        F.col("act_weighted_rows").alias("user_operate_video_weight"),
        ds.step_weight_sum(days).alias("operate_video_day_occupy")))


def page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(act.category_day_stats(_logs(spark, sf_dir).activity, W, "page"))


def action_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(act.category_day_stats(_logs(spark, sf_dir).activity, W, "action_type"))


def action_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act.action_score(_logs(spark, sf_dir).activity, W)


# --- recurrence --------------------------------------------------------------

def _flags(spark, sf_dir, flag, mode):
    logs = _logs(spark, sf_dir)
    parts = [flagged_users(log, W, flag, mode).select(F.lit(name).alias("log"), *KEYS)
             for name, log in (("launch", logs.launch), ("create", logs.create),
                               ("activity", logs.activity))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def cycle_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "cycle", lau.AS_COMPUTED)


def week_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "week", lau.AS_COMPUTED)


def cycle_flags_any_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "cycle", lau.INTENDED)


# --- affinity / popularity ---------------------------------------------------

def item_affinity_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(video_affinity(_logs(spark, sf_dir).activity, W))


def item_affinity_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = pop.author_block(_logs(spark, sf_dir).activity, W)
    return rounded(block.drop("author_atttractive_force"))


def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = _logs(spark, sf_dir).activity
    top = pop.top_authors(pop.author_views(activity, W))
    return top.select("window_id", "author_id", "views", F.col("author_rank").cast("int"))


def author_attraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = pop.author_block(_logs(spark, sf_dir).activity, W)
    return rounded(block.where(F.col("author_atttractive_force") > 0)
                   .select(*KEYS, "author_atttractive_force"))


def user_top_author_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = pop.user_top_authors(_logs(spark, sf_dir).activity, W)
    return sets.select(*KEYS, F.array_join(F.col("top_authors_viewed").cast("array<string>"), ",")
                       .alias("top_authors_viewed"))


def is_author_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    spine = user_spine(logs.register, W, [])
    flags = pop.author_flags(pop.author_views(logs.activity, W))
    return spine.join(flags, KEYS, "left_semi").select(*KEYS)


# --- labels ------------------------------------------------------------------

def label_launch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launch_labels(_logs(spark, sf_dir).launch, W)


def label_any_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return any_log_labels(_logs(spark, sf_dir), W)


# --- feature table -----------------------------------------------------------

HORIZON_FEATURES = (
    [f"video_create{i}_{s}" for i in HORIZONS
     for s in ("day_before_sum", "day_sum_weight", "day_occupy", "num_day")]
    + [f"user_activity{i}_{s}" for i in HORIZONS
       for s in ("day_sum", "day_sum_weight", "day_occupy", "num_day")]
    + [f"weight_user_view_video_{i}_weight_rete" for i in HORIZONS]
    + [f"user_view_same_author_{i}_weight_rate" for i in HORIZONS]
)


def feature_matrix_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_table(_logs(spark, sf_dir), W))


def feature_matrix_w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_table(_logs(spark, sf_dir), [window(W, 1)]))


def feature_matrix_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_table(_logs(spark, sf_dir), W, mode=lau.INTENDED))


def normalized_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = feature_table(_logs(spark, sf_dir), W, columns=HORIZON_FEATURES)
    return rounded(table.select(*KEYS, *HORIZON_FEATURES))


def training_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled windows, which the final model is trained on, in one job."""
    return rounded(feature_table(_logs(spark, sf_dir), [window(W, 1), window(W, 2)]))


def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile(feature_table(_logs(spark, sf_dir), W), exclude=KEYS))


def weekly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight windows a week apart, over more days than one 64-bit bitmap holds; the logs hold all of
    them (65 feature days, 72 with the last label days)."""
    weekly = [FeatureWindow(k + 1, 1 + 7 * k, 16 + 7 * k, True) for k in range(8)]
    days = day_span(weekly, with_label_days=True)[1]
    return rounded(feature_table(fixture_logs(spark, sf_dir, days), weekly))


def incremental_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows from stored day counts: 23 days first, then the week that is new."""
    raw, root = (checkpoint_path(spark, f"{name}_{uuid.uuid4().hex}") for name in ("logs", "days"))
    write_parquet_logs(_logs(spark, sf_dir), raw)
    logs = read_parquet_logs(spark, raw)
    add_days(logs, root, 1, 23)
    add_days(logs, root, 24, 30)
    return rounded(feature_table(read_day_counts(spark, root), W))


def feature_matrix_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with its blocks stored in buckets and joined without a shuffle."""
    place = bucketed(spark, checkpoint_path(spark, f"blocks_{uuid.uuid4().hex}"))
    return rounded(feature_table(_logs(spark, sf_dir), W, place=place))


def stored_window_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Launch days of the labelled windows, both read from storage: logs by day, windows as a table."""
    raw, path = (checkpoint_path(spark, f"{name}_{uuid.uuid4().hex}") for name in ("logs", "windows"))
    write_parquet_logs(_logs(spark, sf_dir), raw)
    store_windows(spark, W, path)
    return launches_of_stored_windows(read_parquet_logs(spark, raw).launch, spark.read.parquet(path).where("labelled"))


def user_author_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All authors of each user, through the chunked lists."""
    return (pop.user_author_chunks(_logs(spark, sf_dir).activity, W)
            .select("window_id", "user_id", F.explode("authors").alias("author_id")))


def tsv_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window 1 from the logs' raw form: header-less tab-separated files in the shared folder."""
    paths = write_tsv_logs(_logs(spark, sf_dir), checkpoint_path(spark, f"tsv_{uuid.uuid4().hex}"))
    return rounded(feature_table(read_tsv_logs(spark, **paths), [window(W, 1)]))


def windows_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table stored with a folder per window and read back."""
    path = checkpoint_path(spark, f"features_{uuid.uuid4().hex}")
    table = feature_table(_logs(spark, sf_dir), W)
    write_feature_table(table, path)
    return rounded(read_feature_table(spark, path).select(*table.columns))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table written as CSV with a header (the interchange format of
    the training scripts) into the shared checkpoint folder, then read back."""
    table = feature_table(_logs(spark, sf_dir), W)
    path = checkpoint_path(spark, f"feature_csv_{uuid.uuid4().hex}")
    write_feature_csv(table, path)
    return rounded(read_feature_csv(spark, path, table.schema))


# --- model jobs -----------------------------------------------------------------

def auc_of_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC of one fixed column against the label, per labelled window."""
    from . import model as m
    table = feature_table(_logs(spark, sf_dir), W, columns=["video_operate_times"], label=True)
    return rounded(m.auc(table.where("label IS NOT NULL"), "video_operate_times", [1, 2]))


def _materialized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, written to the shared checkpoint folder: the learner
    scans it many times and must not re-run the log aggregations."""
    path = checkpoint_path(spark, f"features_{uuid.uuid4().hex}")
    write_feature_table(feature_table(_logs(spark, sf_dir), W), path)
    return read_feature_table(spark, path)


def _tuned(spark: SparkSession, sf_dir: str):
    """The table and the model of the tuning job, full budget; one fit serves this session's queries on a folder."""
    from . import model as m
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fits:
        table = _materialized_table(spark, sf_dir)
        _fits.clear()
        _fits[key] = table, m.fit_with_patience(table, [1], 2, m.TUNING)
    return _fits[key]


_fits: dict = {}


def gbt_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import model as m
    table, model = _tuned(spark, sf_dir)
    return rounded(m.evaluate(model, table, [1, 2]))


def gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split counts of the tuned model, through their sink."""
    from . import model as m
    _, model = _tuned(spark, sf_dir)
    path = checkpoint_path(spark, f"importances_{uuid.uuid4().hex}")
    write_importances(m.split_importances(model), path)
    return read_importances(spark, path)


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of window 3, through their sink, by a fit of the tuned number of rounds on both labelled windows."""
    from . import model as m
    table, tuned = _tuned(spark, sf_dir)
    model = m.fit(table, [1, 2], replace(m.TUNING, max_iter=tuned.gbt.getNumTrees))
    path = checkpoint_path(spark, f"scores_{uuid.uuid4().hex}")
    write_scores(m.score(model, table, 3), path)
    return read_scores(spark, path)


def importance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature once in the importances, none with a negative score."""
    return gbt_importance(spark, sf_dir).select("feature", (F.col("score") >= 0).alias("valid"))


def score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score for every user of window 3, each between 0 and 1."""
    return gbt_scores(spark, sf_dir).select("user_id", F.col("predicted_score").between(0, 1).alias("valid"))


# --- boosted trees in blocks ------------------------------------------------------

#: The combinations of the registered search, as changes to the tuning settings.
SEARCH = {f"depth={d}, step={x}": dict(depth=d, step=x) for d in (3, 5) for x in (0.05, 0.1)}
_boosted: dict = {}


def _boosting(spark: SparkSession, sf_dir: str, name: str):
    """The stored results of one boosting job; a session runs each once for a folder."""
    from . import boosting as b
    key = (spark.sparkContext.applicationId, sf_dir)
    if _boosted.get("of") != key:
        _boosted.clear()
        _boosted["of"] = key
        _boosted["table"] = _materialized_table(spark, sf_dir)
    table, folder = _boosted["table"], checkpoint_path(spark, f"boosting_{uuid.uuid4().hex}")
    if name not in _boosted:
        if name == "final":
            data = b.prepared(table, [1, 2])
            train = data.rows.where("window_id in (1, 2)")
            fit, base = b.begin(data, train, b.FINAL, folder), b.training_blocks(train, len(data.features))
            _boosted[name] = data, b.advance(fit, base, b.FINAL.rounds, block=100)
            base.unpersist()
        else:
            data = b.prepared(table, [1])
            _boosted[name] = data, *b.fit_with_patience(data, 1, [1, 2], b.TUNING, folder)
    return _boosted[name]


def final_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of window 3 by the final model: all its rounds on both labelled windows, through their sink."""
    from . import boosting as b
    data, fit = _boosting(spark, sf_dir, "final")
    path = checkpoint_path(spark, f"scores_{uuid.uuid4().hex}")
    write_scores(b.scores(fit, data.rows.where("window_id = 3")), path)
    return read_scores(spark, path)


def final_node_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the final model's stored trees are as many as its rounds, and their nodes add up, level by level."""
    from . import boosting as b
    data, fit = _boosting(spark, sf_dir, "final")
    faults = b.node_faults(fit, data.rows.where("window_id in (1, 2)")).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))
    kinds = spark.createDataFrame([(k,) for k in ("rows", "grad", "hess", "gain", "depth", "least", "children", "value", "root")], "fault string")
    trees = fit.node_table(spark).agg(F.countDistinct("tree").alias("trees"))
    return (kinds.join(faults, "fault", "left").select("fault", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .unionByName(trees.select(F.lit("missing trees").alias("fault"), (F.lit(b.FINAL.rounds) - F.col("trees")).cast("long").alias("n"))))


def final_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split counts of the final model from its stored nodes, through their sink."""
    from . import boosting as b
    _, fit = _boosting(spark, sf_dir, "final")
    path = checkpoint_path(spark, f"importances_{uuid.uuid4().hex}")
    write_importances(b.split_counts(fit, spark), path)
    return read_importances(spark, path)


def tuning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of both labelled windows after every round of the tuning job, which ends on it."""
    _, _, curve = _boosting(spark, sf_dir, "tuning")
    return rounded(spark.createDataFrame(curve, "window_id int, round int, auc double"))


def parameter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each combination, fitted side by side on window 1 and halved by the AUC of window 2."""
    from . import boosting as b
    data, *_ = _boosting(spark, sf_dir, "tuning")
    found = b.halving(data, 1, 2, {n: replace(b.TUNING, **x) for n, x in SEARCH.items()}, checkpoint_path(spark, f"search_{uuid.uuid4().hex}"))
    return rounded(found)
