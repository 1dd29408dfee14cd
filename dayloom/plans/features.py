"""The wide per-user feature table, all windows in one job.

Plan shape.  No raw log row is duplicated per window: every log is first
aggregated without the window key -- one bitmap per window for each user
(or user and item), or counts per (user, log day) -- and the fan-out to
the windows happens on those aggregated rows, by ``inline`` or ``explode``
over a literal array.

* spine           register -> explode windows                     (1 exchange)
* launch          bitmaps per user -> rows per window             (1 exchange)
* creation        counts per (user, day) -> per (w, u)            (2 exchanges)
* activity        counts per (user, day) -> per (w, u)            (2 exchanges)
* items           bitmaps and counts per (user, video | author), one read and
                  one exchange for the three uses below:
    affinity      + broadcast top-k authors -> max / share (w, u) (1 exchange)
    views         sums per author -> rows per window              (1 exchange)
    top k         group limit per window over the views           (1 exchange)

Every block ends keyed by ``(window_id, user_id)`` and is left-joined onto the
spine (sort-merge joins; AQE turns the small ones into broadcast joins from
runtime sizes).  All aggregates are partial/final (map-side combined), so a
user or author holding a third of the rows is reduced to one row per task
before any shuffle; the only per-group collections are bounded (16 days, or
the k popular authors).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame

from ..functions.weights import HORIZONS, rate_sql, weight_cap_sql, zero_sql
from ..operators.activity import CATEGORIES, activity_block, activity_features, category_name
from ..operators.affinity import grain_of_item_days, item_grain
from ..operators.creation import creation_block, creation_features
from ..operators.launch import AS_COMPUTED, INTENDED, launch_block, launch_features
from ..operators.popularity import author_flags, grain_views, item_block
from ..operators.spine import register_type_categories, user_spine
from ..operators.windows import STANDARD_WINDOWS, FeatureWindow, labelled_ids
from ..sources.logs import DayCounts, Logs

KEYS = ["window_id", "user_id"]


def _activity_columns(mode: str) -> list[tuple[str, str]]:
    """Activity features in the feature table's column order (SQL text)."""
    base = dict(activity_features(mode))
    zero = zero_sql
    order = [
        "video_operate_times", "user_operate_video_weight",
        "user_operate_video_day_max", "user_operate_video_day_min",
        "user_operate_video_day_mean", "user_operate_video_day_median",
        "user_operate_video_day_std", "user_operate_video_day_var",
        "operate_video_distance_day", "operate_video_day_occupy",
        "user_operate_video_day_num",
    ]
    out = [(c, base[c]) for c in order]
    out += [("weight_user_view_video_weight", zero("weight_user_view_video_weight")),
            ("user_view_same_author_weight", zero("user_view_same_author_weight"))]
    for c, v in CATEGORIES:
        f = category_name(c, v)
        names = [f"user_operate_{f}_sum", f"day_distance_to_operate_{f}",
                 f"last_day_operate_{f}_times", f"user_operated_{f}_day_max"]
        if mode == INTENDED:
            names.append(f"user_operated_{f}_day_min")
        names += [f"user_operated_{f}_day_median", f"user_operated_{f}_day_std",
                  f"user_operated_{f}_day_var", f"user_operated_{f}_day_mean",
                  f"user_operate_{f}_occupy", f"user_operate_{f}_day_ocupy"]
        out += [(n, base[n]) for n in names]
    for i in HORIZONS:
        out += [(f"weight_user_view_video_{i}_weight", zero(f"weight_user_view_video_{i}_weight")),
                (f"user_view_same_author_{i}_weight", zero(f"user_view_same_author_{i}_weight"))]
        out += [(n, base[n]) for n in (f"user_activity{i}_day_sum",
                                       f"user_activity{i}_day_sum_weight",
                                       f"user_activity{i}_day_occupy",
                                       f"user_activity{i}_num_day")]
    out += [(n, base[n]) for n in ("user_activity_diff_day_max", "user_activity_diff_day_min",
                                   "user_activity_diff_day_mean")]
    out.append(("author_atttractive_force", zero("author_atttractive_force")))
    for i in HORIZONS:
        out += [
            (f"weight_user_view_video_{i}_weight_rete",
             zero(rate_sql(f"weight_user_view_video_{i}_weight", weight_cap_sql(i)))),
            (f"user_view_same_author_{i}_weight_rate",
             zero(rate_sql(f"user_view_same_author_{i}_weight", weight_cap_sql(i)))),
        ]
    out.append(("user_is_author", zero("user_is_author")))
    out += [(n, base[n]) for n in ("cycle_user_user_activity", "user_week_both_user_activity")]
    return out


def feature_columns(mode: str = AS_COMPUTED) -> list[tuple[str, str]]:
    """All block features (after the spine columns), in table order, as
    ``(name, SQL expression)`` over the spine joined with the blocks."""
    return launch_features(mode) + creation_features(mode) + _activity_columns(mode)


_LAUNCH, _CREATION, _ACTIVITY, _ITEMS, _FLAGS = "launch", "creation", "activity", "items", "flags"


def _block_of(feature: str) -> str:
    """The block that a feature column comes from (either mode)."""
    if feature == "user_is_author":
        return _FLAGS
    if feature.startswith(("weight_user_view_video", "user_view_same_author", "author_atttractive")):
        return _ITEMS
    for block, features in ((_LAUNCH, launch_features), (_CREATION, creation_features)):
        if any(feature == name for mode in (AS_COMPUTED, INTENDED) for name, _ in features(mode)):
            return block
    return _ACTIVITY


def _blocks(logs: Logs, windows: Sequence[FeatureWindow], mode: str, wanted: set[str], label: bool) -> dict[str, DataFrame]:
    """The wanted blocks by name, keyed by window and user; the label is a column of the launch block (and,
    in intended mode, of the other logs' blocks)."""
    counted = isinstance(logs, DayCounts)
    grain = grain_of_item_days(logs.items, windows) if counted else item_grain(logs.activity, windows)
    views = grain_views(grain, windows)
    logs_label = label and mode == INTENDED
    makers = {
        _LAUNCH: (label, lambda: launch_block(logs.launch, windows, mode)),
        _CREATION: (logs_label, lambda: creation_block(logs.create, windows, logs_label, counted)),
        _ACTIVITY: (logs_label, lambda: activity_block(logs.activity, windows, mode, counted)),
        _ITEMS: (False, lambda: item_block(grain, windows, views)),
        _FLAGS: (False, lambda: author_flags(views)),
    }
    return {name: make() for name, (needed, make) in makers.items() if needed or name in wanted}


def feature_table(logs: Logs, windows: Sequence[FeatureWindow] = STANDARD_WINDOWS,
                  mode: str = AS_COMPUTED, categories: Sequence[int] | None = None,
                  columns: Sequence[str] | None = None, label: bool | None = None,
                  place: Callable[[DataFrame, str], DataFrame] = lambda block, name: block) -> DataFrame:
    """One row per (window, registered user); ``label`` is NULL for windows
    without label days.  Feature columns are doubles, spine columns ints.
    ``columns`` limits the features (and leaves out the label, unless ``label``);
    only the blocks that they come from are built.  ``place`` may store the spine and each block, by name,
    before they are joined (``plans/rollup.py``).  A user registered more than once fails the job."""
    label = columns is None if label is None else label
    if mode not in (AS_COMPUTED, INTENDED):
        raise ValueError(f"unknown mode {mode!r}")
    if categories is None:
        categories = register_type_categories(logs.register)
    spine = user_spine(logs.register, windows, categories, once=True)
    wanted = [(name, expr) for name, expr in feature_columns(mode) if columns is None or name in set(columns)]
    joined = place(spine, "spine")
    for name, block in _blocks(logs, windows, mode, {_block_of(name) for name, _ in wanted}, label).items():
        joined = joined.join(place(block, name), KEYS, "left")

    # the ~220 output expressions go in as SQL text: one parse on the JVM
    # instead of thousands of Python->JVM calls to build Column objects
    spine_cols = ["window_id", "user_id", "register_day_distance", "device_type"] + \
        [f"register_type{i}" for i in range(len(categories))]
    feats = [f"CAST({expr} AS DOUBLE) AS {name}" for name, expr in wanted]
    ids = labelled_ids(windows)
    if ids and label:
        raw = "greatest(label_launch, label_create, label_activity)" if mode == INTENDED else "label_launch"
        feats.append(f"CAST(CASE WHEN window_id IN ({', '.join(map(str, ids))}) "
                     f"THEN coalesce({raw}, 0) END AS INT) AS label")
    return joined.selectExpr(*spine_cols, *feats)


def feature_names(table: DataFrame) -> list[str]:
    """Model inputs: every column but keys and label."""
    return [c for c in table.columns if c not in ("window_id", "user_id", "label")]
