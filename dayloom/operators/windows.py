"""Sliding feature windows (one job for all windows).

A window is 16 consecutive feature days ``[feat_begin, feat_end]`` followed,
when labelled, by 7 label days.  Rows are re-based to *window days*:
``wday = day - feat_end + 16`` so the last feature day is 16 and "today" is 17
in every window.

Instead of one pass per window, all windows run in one job.  Two narrow
ways put rows into windows, both applied *after* the first aggregation so
raw rows are never duplicated:

* ``assign_windows``: tag a row carrying a log ``day`` with every window the
  day falls in (``explode`` over a literal array of at most ``len(windows)``
  candidates) -- used on (user, day) count grains;
* ``window_masks`` / ``fan_out_masks``: one bitmap of window days per window
  as aggregate columns, then one row per window.

The union of the windows' day ranges (``in_span``) is a plain range
predicate that reaches the parquet scan (or prunes ``day=`` partitions).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weights import FEATURE_DAYS, LABEL_DAYS, registration_age


@dataclass(frozen=True)
class FeatureWindow:
    window_id: int
    feat_begin: int
    feat_end: int
    labelled: bool = True

    def __post_init__(self):
        if self.feat_end - self.feat_begin + 1 != FEATURE_DAYS:
            raise ValueError(f"a feature window spans {FEATURE_DAYS} days: {self}")

    @property
    def slide(self) -> int:
        """Offset that maps a log day to a window day."""
        return self.feat_end - FEATURE_DAYS

    @property
    def label_begin(self) -> int:
        return self.feat_end + 1

    @property
    def label_end(self) -> int:
        return self.feat_end + LABEL_DAYS


# The three windows of the task: two labelled for training / validation,
# the last one scored.
STANDARD_WINDOWS = (
    FeatureWindow(1, 1, 16, True),
    FeatureWindow(2, 8, 23, True),
    FeatureWindow(3, 15, 30, False),
)


def window(windows: Sequence[FeatureWindow], window_id: int) -> FeatureWindow:
    for w in windows:
        if w.window_id == window_id:
            return w
    raise KeyError(window_id)


def _last_day(w: FeatureWindow, with_label_days: bool) -> int:
    return w.label_end if (with_label_days and w.labelled) else w.feat_end


def day_span(windows: Sequence[FeatureWindow], with_label_days: bool = False) -> tuple[int, int]:
    """First and last log day any window reads."""
    return (min(w.feat_begin for w in windows),
            max(_last_day(w, with_label_days) for w in windows))


def in_span(windows: Sequence[FeatureWindow], with_label_days: bool = False,
            day_col: str = "day") -> Column:
    """Range predicate on the log day (pushed into the scan / partition filter)."""
    lo, hi = day_span(windows, with_label_days)
    return F.col(day_col).between(lo, hi)


def window_masks(windows: Sequence[FeatureWindow], with_label_days: bool = False) -> list[Column]:
    """One aggregate per window over a log's ``day``: the bitmap ``m<id>`` of the
    window days present (bits 1..16, plus 17..23 with label days), NULL for none.

    23 bits always fit, however many windows there are and however far apart
    they lie; ``bit_or`` is combined map-side, so the shuffle carries one long
    per key and window, never the raw rows.
    """
    return [F.expr(f"bit_or(CASE WHEN day BETWEEN {w.feat_begin} AND {_last_day(w, with_label_days)} "
                   f"THEN shiftleft(1L, CAST(day - {w.slide} AS INT)) END) AS m{w.window_id}")
            for w in windows]


def fan_out_masks(df: DataFrame, windows: Sequence[FeatureWindow], out_col: str,
                  keep: Sequence[str]) -> DataFrame:
    """Rows with ``window_masks`` columns as one row per window that has days:
    ``window_id``, ``out_col`` and the ``keep`` columns.  Narrow: no shuffle."""
    rows = ", ".join(f"named_struct('window_id', {w.window_id}, '{out_col}', m{w.window_id})" for w in windows)
    return (df.selectExpr(*keep, f"inline(array({rows}))")
            .where(F.col(out_col).isNotNull()))


def assign_windows(df: DataFrame, windows: Sequence[FeatureWindow],
                   with_label_days: bool = False, day_col: str = "day",
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Tag each row with every window it belongs to.

    Returns ``keep`` columns (default: all but ``day``) plus ``window_id`` and
    ``wday`` (window day; 17..23 are label days).
    """
    day = F.col(day_col)
    lo = min(w.feat_begin for w in windows)
    hi = max(_last_day(w, with_label_days) for w in windows)
    keep = [c for c in df.columns if c != day_col] if keep is None else list(keep)
    candidates = F.array(*[
        F.when(day.between(w.feat_begin, _last_day(w, with_label_days)),
               F.struct(F.lit(w.window_id).alias("window_id"),
                        (day - F.lit(w.slide)).cast("int").alias("wday")))
        for w in windows
    ])
    return (df.where(day.between(lo, hi))
            .select(*keep, F.inline(F.filter(candidates, lambda c: c.isNotNull()))))


def spine_windows(register: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """Register rows tagged with every window whose feature end they precede.

    Adds ``window_id`` and the capped registration age ``register_day_distance``.
    """
    rd = F.col("register_day")
    candidates = F.array(*[
        F.when(rd <= w.feat_end,
               F.struct(F.lit(w.window_id).alias("window_id"),
                        registration_age(rd, w.feat_end).alias("register_day_distance")))
        for w in windows
    ])
    keep = [c for c in register.columns if c != "register_day"]
    return register.select(*keep, F.inline(F.filter(candidates, lambda c: c.isNotNull())))


def labelled_ids(windows: Sequence[FeatureWindow]) -> list[int]:
    return [w.window_id for w in windows if w.labelled]


def assign_label_days(df: DataFrame, windows: Sequence[FeatureWindow],
                      day_col: str = "day") -> DataFrame:
    """Rows that fall on a label day of a labelled window: ``user_id, window_id``."""
    labelled = [w for w in windows if w.labelled]
    if not labelled:
        return df.select("user_id", F.lit(None).cast("int").alias("window_id")).limit(0)
    day = F.col(day_col)
    lo = min(w.label_begin for w in labelled)
    hi = max(w.label_end for w in labelled)
    candidates = F.array(*[
        F.when(day.between(w.label_begin, w.label_end), F.lit(w.window_id))
        for w in labelled
    ])
    return (df.where(day.between(lo, hi))
            .select("user_id", F.explode(F.filter(candidates, lambda c: c.isNotNull()))
                    .alias("window_id")))
