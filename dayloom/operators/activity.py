"""Activity (video interaction) features.

Day grain first: ``(window, user, day)`` with the total row count and one count
per page (0..4) and per action type (0..5) -- a single map-side-combined
aggregate over the raw log.  Then one aggregate per (window, user) computes,
for the total and for each category, the statistics over the days on which
the category occurs (``when(n_f > 0, ...)``), plus a day bitmap per category.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import daysets as ds
from ..functions.weights import (AGE, AGE_WEIGHT, CURRENT_DAY, FEATURE_DAYS, HORIZONS,
                                 age_cap_sql, missing_distance_sql, rate_sql,
                                 step_weight_sql, weight_cap_sql, zero_sql)
from .launch import AS_COMPUTED, INTENDED
from .windows import FeatureWindow, assign_windows, in_span

# Fixed category lists: five pages and six action types.
PAGES = (0, 1, 2, 3, 4)
ACTION_TYPES = (0, 1, 2, 3, 4, 5)
CATEGORIES = tuple([("page", j) for j in PAGES] + [("action_type", j) for j in ACTION_TYPES])


def category_name(column: str, value: int) -> str:
    return f"{column}{value}"


def daily_counts() -> list[Column]:
    """Aggregates of the (user, log day) rollup: rows, and rows per category."""
    return [F.count("*").alias("n")] + [
        F.count_if(F.col(c) == v).alias(category_name(c, v)) for c, v in CATEGORIES]


def activity_days(activity: DataFrame) -> DataFrame:
    """``(user_id, day, n, page0..4, action_type0..5)``: the day grain by log day."""
    return activity.groupBy("user_id", "day").agg(*daily_counts())


def activity_day_grain(activity: DataFrame, windows: Sequence[FeatureWindow],
                       with_label_days: bool = False, counted: bool = False) -> DataFrame:
    """``(window_id, user_id, wday, n, page0..4, action_type0..5)``.

    Counted per (user, log day) -- each raw row once, map-side combined, unless
    ``counted`` already -- then fanned out to the windows containing the day."""
    rows = activity.where(in_span(windows, with_label_days))
    per_day = rows if counted else activity_days(rows)
    return assign_windows(per_day, windows, with_label_days)


def _median(counts: str, field: str) -> str:
    """Exact median of a field's positive counts in a list of at most 16 days (SQL text)."""
    ordered = f"array_sort(filter(transform({counts}, md_x -> md_x.{field}), md_y -> md_y > 0))"
    return (f"transform(array({ordered}), md_s -> CASE WHEN size(md_s) > 0 THEN "
            f"(md_s[size(md_s) div 2] + md_s[(size(md_s) - 1) div 2]) / 2D END)[0]")


def _day_stats(n: str, prefix: str, with_min: bool) -> list[str]:
    """Aggregates (SQL text) over the days on which count column ``n`` > 0."""
    on = f"CASE WHEN {n} > 0 THEN {n} END"
    aggs = [
        f"sum({n}) AS {prefix}_rows",
        f"bit_or(CASE WHEN {n} > 0 THEN shiftleft(1L, wday) END) AS {prefix}_days",
        f"max_by({n}, CASE WHEN {n} > 0 THEN wday END) AS {prefix}_latest_n",
        f"max({on}) AS {prefix}_max",
        f"var_samp({on}) AS {prefix}_var",   # std = sqrt(var), as stddev_samp
    ]
    if with_min:
        aggs.append(f"min({on}) AS {prefix}_min")
    return aggs


def activity_block(activity: DataFrame, windows: Sequence[FeatureWindow],
                   mode: str = AS_COMPUTED, counted: bool = False) -> DataFrame:
    """Per (window, user): total and per-category day statistics, plus the
    horizon sums; one aggregate over the day grain.  The medians come from one
    list of the (at most 16) days' counts, not from a buffer for each of them.
    With the ``intended`` mode ``label_activity`` is 1 with rows on a label day
    (those days count for nothing else)."""
    names = ["n"] + [category_name(c, v) for c, v in CATEGORIES]
    grain = activity_day_grain(activity, windows, mode == INTENDED, counted)
    labels = []
    if mode == INTENDED:
        labels = [f"max(CAST(wday > {FEATURE_DAYS} AS INT)) AS label_activity"]
        grain = grain.selectExpr("window_id", "user_id", "wday",
                                 *[f"CASE WHEN wday <= {FEATURE_DAYS} THEN {c} END AS {c}" for c in names])
    w = step_weight_sql("wday")
    aggs = _day_stats("n", "act", with_min=True)
    aggs.append(f"sum({w} * n) AS act_weighted_rows")
    for i in HORIZONS:
        h = f"wday >= {CURRENT_DAY - i}"
        aggs.append(f"sum(CASE WHEN {h} THEN n ELSE 0 END) AS act_rows_{i}")
        aggs.append(f"sum(CASE WHEN {h} THEN {w} * n ELSE 0D END) AS act_weighted_rows_{i}")
    for c, v in CATEGORIES:
        name = category_name(c, v)
        aggs += _day_stats(name, f"cat_{name}", with_min=(mode == INTENDED))
    fields = ", ".join(f"'{c}', {c}" for c in names)
    aggs.append(f"collect_list(CASE WHEN n IS NOT NULL THEN named_struct({fields}) END) AS day_counts")
    block = grain.groupBy("window_id", "user_id").agg(*[F.expr(a) for a in aggs + labels])
    medians = [_median("day_counts", c) + f" AS {p}_median"
               for c, p in zip(names, ["act"] + [f"cat_{c}" for c in names[1:]])]
    return block.selectExpr(*[c for c in block.columns if c != "day_counts"], *medians)


def raw_row_gaps_sql(days: str, rows: str, max_per_day: str) -> tuple[str, str, str]:
    """Max / min / mean difference between consecutive *rows* sorted by day
    (same-day rows give 0), from the day bitmap and the per-day counts alone:
    no sort of the raw log is needed.  NULL for a single row."""
    k = ds.count_sql(days)
    gmax = f"(CASE WHEN {rows} >= 2 THEN (CASE WHEN {k} >= 2 THEN {ds.gap_max_sql(days)} ELSE 0 END) END)"
    gmin = f"(CASE WHEN {rows} >= 2 THEN (CASE WHEN {max_per_day} > 1 THEN 0 ELSE {ds.gap_min_sql(days)} END) END)"
    gmean = (f"(CASE WHEN {rows} >= 2 THEN "
             f"({ds.last_sql(days)} - {ds.first_sql(days)}) / ({rows} - 1) END)")
    return gmax, gmin, gmean


def activity_features(mode: str = AS_COMPUTED) -> list[tuple[str, str]]:
    """Final activity columns as SQL, except the affinity / popularity ones."""
    days = "act_days"
    zero, seventeen = zero_sql, missing_distance_sql
    out = [
        ("video_operate_times", zero(rate_sql("act_rows", AGE))),
        ("user_operate_video_weight", zero("act_weighted_rows")),
        ("user_operate_video_day_max", zero("act_max")),
        ("user_operate_video_day_min", zero("act_min")),
        ("user_operate_video_day_mean", zero(rate_sql("act_rows", ds.count_sql(days)))),
        ("user_operate_video_day_median", zero("act_median")),
        ("user_operate_video_day_std", zero("sqrt(act_var)")),
        ("user_operate_video_day_var", zero("act_var")),
        ("operate_video_distance_day", seventeen(f"({CURRENT_DAY} - {ds.last_sql(days)})")),
        ("operate_video_day_occupy", zero(rate_sql(ds.step_weight_sum_sql(days), AGE_WEIGHT))),
        ("user_operate_video_day_num", zero(rate_sql(ds.count_sql(days), AGE))),
    ]
    for c, v in CATEGORIES:
        f = category_name(c, v)
        p = f"cat_{f}"
        fdays = f"{p}_days"
        out += [
            (f"user_operate_{f}_sum", zero(rate_sql(f"{p}_rows", AGE))),
            (f"day_distance_to_operate_{f}", seventeen(f"({CURRENT_DAY} - {ds.last_sql(fdays)})")),
            (f"last_day_operate_{f}_times", zero(f"{p}_latest_n")),
            (f"user_operated_{f}_day_max", zero(f"{p}_max")),
        ]
        if mode == INTENDED:
            out.append((f"user_operated_{f}_day_min", zero(f"{p}_min")))
        out += [
            (f"user_operated_{f}_day_median", zero(f"{p}_median")),
            (f"user_operated_{f}_day_std", zero(f"sqrt({p}_var)")),
            (f"user_operated_{f}_day_var", zero(f"{p}_var")),
            (f"user_operated_{f}_day_mean", zero(rate_sql(f"{p}_rows", ds.count_sql(fdays)))),
            (f"user_operate_{f}_occupy", zero(rate_sql(ds.step_weight_sum_sql(fdays), AGE_WEIGHT))),
            (f"user_operate_{f}_day_ocupy", zero(rate_sql(ds.count_sql(fdays), AGE))),
        ]
    for i in HORIZONS:
        h = ds.restrict(days, CURRENT_DAY - i, FEATURE_DAYS)
        out += [
            (f"user_activity{i}_day_sum", zero(rate_sql(f"act_rows_{i}", age_cap_sql(i)))),
            (f"user_activity{i}_day_sum_weight",
             zero(rate_sql(f"act_weighted_rows_{i}", weight_cap_sql(i)))),
            (f"user_activity{i}_day_occupy",
             zero(rate_sql(ds.step_weight_sum_sql(h), weight_cap_sql(i)))),
            (f"user_activity{i}_num_day", zero(rate_sql(ds.count_sql(h), age_cap_sql(i)))),
        ]
    gmax, gmin, gmean = raw_row_gaps_sql(days, "act_rows", "act_max")
    out += [
        ("user_activity_diff_day_max", seventeen(gmax)),
        ("user_activity_diff_day_min", seventeen(gmin)),
        ("user_activity_diff_day_mean", seventeen(gmean)),
    ]
    cycle = (ds.any_weekly_pair_sql(days, FEATURE_DAYS - 9, FEATURE_DAYS) if mode == INTENDED
             else ds.weekly_pair_sql(days, FEATURE_DAYS))
    week = f"({ds.any_day_sql(days, 13, 14)} AND {ds.any_day_sql(days, 6, 7)})"
    out += [
        ("cycle_user_user_activity", zero(f"CAST({cycle} AS INT)")),
        ("user_week_both_user_activity", zero(f"CAST({week} AS INT)")),
    ]
    return out


def activity_row_gaps(activity: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(window_id, user_id, user_activity_diff_day_{max,min,mean})`` -- gaps
    between consecutive raw rows, NULL for a single row."""
    per_day = (activity.where(in_span(windows)).groupBy("user_id", "day")
               .agg(F.count("*").alias("n")))
    grain = assign_windows(per_day, windows)
    per_user = grain.groupBy("window_id", "user_id").agg(
        F.bit_or(ds.day_bit(F.col("wday"))).alias("days"),
        F.sum("n").alias("rows"), F.max("n").alias("max_per_day"))
    gmax, gmin, gmean = raw_row_gaps_sql("days", "rows", "max_per_day")
    return per_user.selectExpr("window_id", "user_id",
                               f"CAST({gmax} AS DOUBLE) AS user_activity_diff_day_max",
                               f"CAST({gmin} AS DOUBLE) AS user_activity_diff_day_min",
                               f"CAST({gmean} AS DOUBLE) AS user_activity_diff_day_mean")


def category_day_stats(activity: DataFrame, windows: Sequence[FeatureWindow],
                       column: str) -> DataFrame:
    """Long form of the per-category statistics: one row per
    ``(window_id, user_id, category)`` with ``category = <column><value>``.

    The narrow alternative to the wide block: one small aggregate keyed by
    the category instead of one aggregate column per category."""
    per_day = (activity.where(in_span(windows)).groupBy("user_id", column, "day")
               .agg(F.count("*").alias("n")))
    grain = assign_windows(per_day, windows)
    n, wday = F.col("n"), F.col("wday")
    stats = grain.groupBy("window_id", "user_id", column).agg(
        F.sum(n).alias("rows"),
        F.bit_or(ds.day_bit(wday)).alias("days_set"),
        F.max_by(n, wday).alias("latest_n"),
        F.max(n).alias("day_max"), F.min(n).alias("day_min"),
        F.median(n).alias("day_median"), F.var_samp(n).alias("day_var"))
    days = "days_set"
    return stats.select(
        "window_id", "user_id",
        F.concat(F.lit(column), F.col(column).cast("string")).alias("category"),
        "rows", (F.lit(CURRENT_DAY) - ds.last_day(days)).alias("last_day_distance"),
        "latest_n", "day_max", "day_min", "day_median",
        F.sqrt("day_var").alias("day_std"), "day_var",
        (F.col("rows") / ds.count_days(days)).alias("day_mean"),
        ds.step_weight_sum(days).alias("occupy"),
        ds.count_days(days).alias("active_days"))


# Fixed action-type weights of the (disabled) activity score:
# types 0..3 score type + 1, types 4 and 5 score type - 6.
def action_score(activity: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    a = F.col("action_type")
    per_day = (activity.where(in_span(windows)).groupBy("user_id", "day")
               .agg(F.sum(F.when(a <= 3, a + 1).otherwise(a - 6)).alias("score")))
    return (assign_windows(per_day, windows).groupBy("window_id", "user_id")
            .agg(F.sum("score").cast("long").alias("action_score")))
