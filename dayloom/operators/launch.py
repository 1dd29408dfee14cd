"""App-launch features.

The launch log has set semantics (a user launches on a day or not), so the
whole block is one aggregate: the per-(window, user) day bitmap, with label
days 17..23 in the same long.  Every feature is a scalar expression on it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import daysets as ds
from ..functions.weights import (AGE_WEIGHT, CURRENT_DAY, FEATURE_DAYS, HORIZONS, LABEL_DAYS,
                                 age_cap_sql, missing_distance_sql, rate_sql, weight_cap_sql,
                                 zero_sql)
from .windows import FeatureWindow, fan_out_masks, in_span, window_masks

AS_COMPUTED = "as_computed"
INTENDED = "intended"


def launch_day_sets(launch: DataFrame, windows: Sequence[FeatureWindow],
                    with_label_days: bool = True) -> DataFrame:
    """``(window_id, user_id, launch_days)``; bit d = launched on window day d.

    One aggregate keyed by the user alone builds every window's bitmap, so raw
    rows are neither duplicated per window nor shuffled more than once.
    """
    per_user = (launch.where(in_span(windows, with_label_days))
                .groupBy("user_id").agg(*window_masks(windows, with_label_days)))
    return fan_out_masks(per_user, windows, "launch_days", ["user_id"])


def _feature_days() -> str:
    return ds.restrict("launch_days", 1, FEATURE_DAYS)


def launch_label(days: str) -> Column:
    """1 when the user launched on a label day (window days 17..23)."""
    return ds.any_day(days, CURRENT_DAY, CURRENT_DAY + LABEL_DAYS - 1).cast("int")


def launch_raw_columns(mode: str = AS_COMPUTED) -> list[Column]:
    """Per-user launch statistics before normalisation (NULL = no launch)."""
    f = _feature_days()
    active = ~ds.is_empty(f)
    cols = [
        (F.lit(CURRENT_DAY) - ds.last_day(f)).alias("user_launch_last_day_distance"),
        ds.gap_max(f).alias("diff_day_max"),
        ds.gap_min(f).alias("diff_day_min"),
        ds.gap_mean(f).alias("diff_day_mean"),
    ]
    for i in HORIZONS:
        cols.append(F.when(active, ds.count_days(f, CURRENT_DAY - i, FEATURE_DAYS))
                    .alias(f"app_launch{i}_day_before_rate"))
    if mode == INTENDED:
        # the first block's cycle test meant "any day d of the last ten with d-7"
        cycle = ds.any_weekly_pair(f, FEATURE_DAYS - 9, FEATURE_DAYS)
        occupied = ds.step_weight_sum(f)
        for i in HORIZONS:
            cols.append(F.when(active, ds.step_weight_sum(
                ds.restrict(f, CURRENT_DAY - i, FEATURE_DAYS)))
                .alias(f"app_launch{i}_day_before_occupy"))
    else:
        cycle = ds.weekly_pair(f, FEATURE_DAYS)
        occupied = ds.cumulative_weight_sum(f)
    cols += [
        F.when(active, cycle.cast("int")).alias("cycle_user"),
        F.when(active, (ds.any_day(f, 13, 14) & ds.any_day(f, 6, 7)).cast("int"))
        .alias("cycle_week_user"),
        F.when(active, occupied).alias("user_launch_date_occupied"),
    ]
    return cols


def launch_features(mode: str = AS_COMPUTED) -> list[tuple[str, str]]:
    """Final launch columns as SQL over a frame holding the raw columns and the
    spine's age columns.  Missing values are filled as the feature table
    expects (gaps 17, everything else 0)."""
    out = [("user_launch_last_day_distance", zero_sql("user_launch_last_day_distance"))]
    for c in ("diff_day_max", "diff_day_min", "diff_day_mean"):
        out.append((c, missing_distance_sql(c)))
    for i in HORIZONS:
        name = f"app_launch{i}_day_before_rate"
        raw = zero_sql(name)
        out.append((name, rate_sql(raw, age_cap_sql(i)) if mode == INTENDED else raw))
    if mode == INTENDED:
        for i in HORIZONS:
            name = f"app_launch{i}_day_before_occupy"
            out.append((name, zero_sql(rate_sql(name, weight_cap_sql(i)))))
    out += [
        ("cycle_user", zero_sql("cycle_user")),
        ("cycle_week_user", zero_sql("cycle_week_user")),
        ("user_launch_date_occupied_avg",
         zero_sql(rate_sql("user_launch_date_occupied", AGE_WEIGHT))),
    ]
    return out


def launch_block(launch: DataFrame, windows: Sequence[FeatureWindow],
                 mode: str = AS_COMPUTED) -> DataFrame:
    """``(window_id, user_id, raw launch columns..., label_launch)``."""
    sets = launch_day_sets(launch, windows, with_label_days=True)
    return sets.select("window_id", "user_id", *launch_raw_columns(mode),
                       launch_label("launch_days").alias("label_launch"))
