"""User-item affinity: the item a user returned to most, weighted by recency.

For an item column (video, author): take the distinct days on which the user
touched each item, sum the step weights of those days per (user, item), and
keep the maximum per user -- over the whole window and over each trailing
horizon.

Plan: one aggregate keyed ``(window, user, item)`` whose only buffer is the
day bitmap (``bit_or``, map-side combined), then the weight sums as scalar
expressions on the bitmap and a ``max`` per (window, user).  Two shuffles,
both of pre-aggregated rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import daysets as ds
from ..functions.weights import CURRENT_DAY, FEATURE_DAYS, HORIZONS
from .windows import FeatureWindow, fan_out_masks, in_span, window_masks


def item_day_sets(activity: DataFrame, windows: Sequence[FeatureWindow],
                  item: str) -> DataFrame:
    """``(window_id, user_id, <item>, days)``: distinct days per user and item.

    One aggregate per (user, item) with one bitmap per window: raw rows are
    aggregated once, not once per window."""
    per_item = (activity.where(in_span(windows)).groupBy("user_id", item)
                .agg(*window_masks(windows)))
    return fan_out_masks(per_item, windows, "days", ["user_id", item])


def item_weights(days_col: str = "days") -> list[str]:
    """Weighted distinct-day sums per (user, item): full window + horizons (SQL)."""
    cols = [f"{ds.step_weight_sum_sql(days_col)} AS w_all"]
    for i in HORIZONS:
        h = ds.restrict(days_col, CURRENT_DAY - i, FEATURE_DAYS)
        cols.append(f"{ds.step_weight_sum_sql(h)} AS w_{i}")
    return cols


def max_item_affinity(item_sets: DataFrame, full_name: str, horizon_name: str,
                      extra_aggs: Sequence = ()) -> DataFrame:
    """``max`` over items of the weighted day sums.

    ``horizon_name`` is a format string with ``{i}`` for the horizon.
    A horizon with no touched item gives NULL, as the feature expects.
    """
    weights = item_sets.selectExpr("*", *item_weights())
    aggs = [f"max(w_all) AS {full_name}"] + [
        f"max(CASE WHEN w_{i} > 0 THEN w_{i} END) AS {horizon_name.format(i=i)}"
        for i in HORIZONS]
    return (weights.groupBy("window_id", "user_id")
            .agg(*[F.expr(a) for a in aggs], *extra_aggs))


VIDEO, AUTHOR = "video", "author"


def item_grain(activity: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(user_id, kind, item)`` with each window's day bitmap ``m<id>`` and rows ``c<id>``.

    Videos and authors in one aggregate over one read of the log: the rows are
    doubled in memory, before the map-side combine, instead of read and parsed twice.
    Users are never null in a log; saying so keeps the grain the same for its readers,
    some of which join on the user.
    """
    rows = [F.expr(f"count_if(day BETWEEN {w.feat_begin} AND {w.feat_end}) AS c{w.window_id}") for w in windows]
    return (activity.where(in_span(windows) & F.col("user_id").isNotNull())
            .selectExpr("user_id", "day", f"stack(2, '{VIDEO}', video_id, '{AUTHOR}', author_id) AS (kind, item)")
            .groupBy("user_id", "kind", "item").agg(*window_masks(windows), *rows))


def item_days(activity: DataFrame) -> DataFrame:
    """``(user_id, kind, item, day, n)``: rows per user, video or author, and log day."""
    return (activity.where(F.col("user_id").isNotNull())
            .selectExpr("user_id", "day", f"stack(2, '{VIDEO}', video_id, '{AUTHOR}', author_id) AS (kind, item)")
            .groupBy("user_id", "kind", "item", "day").agg(F.count("*").alias("n")))


def grain_of_item_days(items: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``item_grain`` from ``item_days``."""
    rows = [F.expr(f"sum(CASE WHEN day BETWEEN {w.feat_begin} AND {w.feat_end} THEN n ELSE 0 END) AS c{w.window_id}") for w in windows]
    return items.where(in_span(windows)).groupBy("user_id", "kind", "item").agg(*window_masks(windows), *rows)


def item_sets(grain: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(window_id, user_id, kind, item, days)`` of the grain's windows with days.

    The (always true) condition on the row counts keeps the grain's columns the
    same for all its readers, so that the plan has its aggregate and exchange once.
    """
    some = " + ".join(f"c{w.window_id}" for w in windows)
    return fan_out_masks(grain.where(f"{some} > 0"), windows, "days", ["user_id", "kind", "item"])


def video_affinity(activity: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    return max_item_affinity(item_day_sets(activity, windows, "video_id"),
                             "weight_user_view_video_weight",
                             "weight_user_view_video_{i}_weight")
