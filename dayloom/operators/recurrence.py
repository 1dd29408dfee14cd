"""Weekly recurrence flags over any log.

* cycle flag: active on the last feature day and on the same weekday a week
  earlier (window days 16 and 9); ``intended`` mode: on any day d of the last
  ten (7..16) and on d - 7;
* week flag: active on one of window days 13-14 and on one of 6-7.

Both are bit tests on the per-(window, user) day bitmap, so the nine
intersections of user sets the flags stand for cost one aggregate.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame

from ..functions import daysets as ds
from ..functions.weights import FEATURE_DAYS
from .launch import AS_COMPUTED, INTENDED
from .windows import FeatureWindow, fan_out_masks, in_span, window_masks


def day_sets(log: DataFrame, windows: Sequence[FeatureWindow],
             with_label_days: bool = False) -> DataFrame:
    """``(window_id, user_id, days)`` for any log with ``user_id, day``."""
    per_user = (log.where(in_span(windows, with_label_days)).groupBy("user_id")
                .agg(*window_masks(windows, with_label_days)))
    return fan_out_masks(per_user, windows, "days", ["user_id"])


def cycle_flag(days: str, mode: str = AS_COMPUTED) -> Column:
    f = ds.restrict(days, 1, FEATURE_DAYS)
    if mode == INTENDED:
        return ds.any_weekly_pair(f, FEATURE_DAYS - 9, FEATURE_DAYS)
    return ds.weekly_pair(f, FEATURE_DAYS)


def week_flag(days: str) -> Column:
    return ds.any_day(days, 13, 14) & ds.any_day(days, 6, 7)


def flagged_users(log: DataFrame, windows: Sequence[FeatureWindow], flag: str,
                  mode: str = AS_COMPUTED) -> DataFrame:
    """``(window_id, user_id)`` of the users that carry ``flag`` ('cycle' / 'week')."""
    sets = day_sets(log, windows)
    cond = cycle_flag("days", mode) if flag == "cycle" else week_flag("days")
    return sets.where(cond).select("window_id", "user_id")
