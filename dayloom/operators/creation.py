"""Video-creation features.

The creation log has bag semantics (one row per video), so the block goes
through the day grain: ``(window, user, day) -> n`` (map-side combined), then
one aggregate per (window, user) that keeps the day bitmap next to the count
statistics.  Distinct-day features come from the bitmap, row features from
the counts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import daysets as ds
from ..functions.weights import (AGE, AGE_WEIGHT, CURRENT_DAY, FEATURE_DAYS, HORIZONS,
                                 age_cap_sql, missing_distance_sql, rate_sql,
                                 step_weight_sql, weight_cap_sql, zero_sql)
from .launch import AS_COMPUTED, INTENDED
from .windows import FeatureWindow, assign_windows, in_span


def user_days(log: DataFrame) -> DataFrame:
    """``(user_id, day, n)``: rows per user and log day."""
    return log.groupBy("user_id", "day").agg(F.count("*").alias("n"))


def day_grain(log: DataFrame, windows: Sequence[FeatureWindow],
              with_label_days: bool = False, counted: bool = False) -> DataFrame:
    """``(window_id, user_id, wday, n)``: rows per user and window day.

    Counted per (user, log day) first -- map-side combined, each raw row
    once, unless ``counted`` already -- and only then fanned out to the windows containing the day."""
    rows = log.where(in_span(windows, with_label_days))
    per_day = rows if counted else user_days(rows)
    return assign_windows(per_day, windows, with_label_days=with_label_days)


def creation_block(create: DataFrame, windows: Sequence[FeatureWindow], with_label: bool = False,
                   counted: bool = False) -> DataFrame:
    """Per (window, user): day bitmap and count statistics of the day grain; ``with_label`` adds
    ``label_create``, 1 with rows on a label day (those days count for nothing else)."""
    w = step_weight_sql("wday")
    aggs = [
        "bit_or(CASE WHEN n IS NOT NULL THEN shiftleft(1L, wday) END) AS create_days",
        "sum(n) AS create_rows",
        f"sum({w} * n) AS create_weighted_rows",
        "max(n) AS create_day_max",
        "min(n) AS create_day_min",
        "max_by(n, CASE WHEN n IS NOT NULL THEN wday END) AS create_latest_n",
    ]
    for i in HORIZONS:
        h = f"wday >= {CURRENT_DAY - i}"
        aggs.append(f"sum(CASE WHEN {h} THEN n ELSE 0 END) AS create_rows_{i}")
        aggs.append(f"sum(CASE WHEN {h} THEN {w} * n ELSE 0D END) AS create_weighted_rows_{i}")
    grain = day_grain(create, windows, with_label, counted)
    if with_label:
        aggs.append(f"max(CAST(wday > {FEATURE_DAYS} AS INT)) AS label_create")
        grain = grain.selectExpr("window_id", "user_id", "wday", f"CASE WHEN wday <= {FEATURE_DAYS} THEN n END AS n")
    return grain.groupBy("window_id", "user_id").agg(*[F.expr(a) for a in aggs])


def creation_features(mode: str = AS_COMPUTED) -> list[tuple[str, str]]:
    """Final creation columns as SQL (raw block columns + spine age columns)."""
    days = "create_days"
    n_days = ds.count_sql(days)
    zero, seventeen = zero_sql, missing_distance_sql
    out = [
        ("create_video_diff_day_max", seventeen(ds.gap_max_sql(days))),
        ("create_video_diff_day_min", seventeen(ds.gap_min_sql(days))),
        ("create_video_diff_day_mean", seventeen(ds.gap_mean_sql(days))),
        ("user_video_create_latest_day_distance",
         seventeen(f"({CURRENT_DAY} - {ds.last_sql(days)})")),
        ("user_video_create_latest_day_num", zero("create_latest_n")),
        ("user_video_create_day_max", zero("create_day_max")),
        ("user_video_create_day_min", zero("create_day_min")),
        ("user_video_create_day_mean", zero(rate_sql("create_rows", n_days))),
    ]
    for i in HORIZONS:
        h = ds.restrict(days, CURRENT_DAY - i, FEATURE_DAYS)
        out += [
            (f"video_create{i}_day_before_sum", zero(rate_sql(f"create_rows_{i}", age_cap_sql(i)))),
            (f"video_create{i}_day_sum_weight",
             zero(rate_sql(f"create_weighted_rows_{i}", weight_cap_sql(i)))),
            (f"video_create{i}_day_occupy",
             zero(rate_sql(ds.step_weight_sum_sql(h), weight_cap_sql(i)))),
            (f"video_create{i}_num_day", zero(rate_sql(ds.count_sql(h), age_cap_sql(i)))),
        ]
    cycle = (ds.any_weekly_pair_sql(days, FEATURE_DAYS - 9, FEATURE_DAYS) if mode == INTENDED
             else ds.weekly_pair_sql(days, FEATURE_DAYS))
    week = f"({ds.any_day_sql(days, 13, 14)} AND {ds.any_day_sql(days, 6, 7)})"
    out += [
        ("cycle_user_create_video", zero(f"CAST({cycle} AS INT)")),
        ("user_week_both_create_video", zero(f"CAST({week} AS INT)")),
        ("video_create_avg", zero(rate_sql("create_rows", AGE))),
        ("user_create_video_day_num_occupy", zero(rate_sql(n_days, AGE))),
        ("user_video_create_day_occupy_rate",
         zero(rate_sql(ds.step_weight_sum_sql(days), AGE_WEIGHT))),
        ("weight_create_count_rate", zero(rate_sql("create_weighted_rows", AGE_WEIGHT))),
    ]
    return out
