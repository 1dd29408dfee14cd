"""Day sets as 64-bit bitmaps.

A user's active days inside one window fit in one ``long``: bit ``d`` is set
when the user was active on window day ``d`` (1..16 feature days, 17..23
label days).  ``bit_or(day_bit(day))`` is an algebraic aggregate, so Spark
combines it map-side and shuffles one long per (window, user[, item])
whatever the number of raw rows -- a hot user costs no more than a quiet one.

Everything the features need from a *set* of days (counts in a range,
latest/earliest day, recurrence pairs, gaps between consecutive days,
weight sums) is then a scalar expression on the bitmap.  Only the gap
statistics need a higher-order function, over at most 16 elements.

A bitmap argument is the SQL text of a ``long`` expression -- usually a
column name, or the result of ``restrict``.  The helpers return ``Column``
objects parsed from SQL: one JVM call per feature instead of one per
operator keeps building the ~200-column plans cheap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .weights import CUMULATIVE_WEIGHTS, FEATURE_DAYS, STEP_WEIGHTS


def day_bit(day: Column) -> Column:
    """``1 << day`` as a long (the aggregate input of a bitmap)."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), day)


def bits(lo: int, hi: int) -> int:
    """Python bitmap with days ``lo..hi`` set."""
    return sum(1 << d for d in range(lo, hi + 1))


# --- SQL text builders (used inside larger SQL feature expressions) ----------

def restrict(mask: str, lo: int, hi: int) -> str:
    """The bitmap limited to days ``lo..hi`` (SQL text)."""
    return f"({mask} & {bits(lo, hi)}L)"


def _count(mask: str, lo: int = 1, hi: int = FEATURE_DAYS) -> str:
    return f"CAST(bit_count({restrict(mask, lo, hi)}) AS BIGINT)"


def _last(mask: str) -> str:
    return f"(CASE WHEN {mask} <> 0 THEN length(bin({mask})) - 1 END)"


def _first(mask: str) -> str:
    return f"(CASE WHEN {mask} <> 0 THEN length(bin({mask} & -{mask})) - 1 END)"


def _day_list(mask: str) -> str:
    return f"filter(sequence(1, {FEATURE_DAYS}), dl_x -> getbit({mask}, dl_x) = 1)"


def _gaps(mask: str) -> str:
    days = _day_list(mask)
    return (f"filter(zip_with(slice({days}, 2, {FEATURE_DAYS}), {days}, "
            f"(dl_a, dl_b) -> dl_a - dl_b), dl_g -> dl_g IS NOT NULL)")


def _step_weight_sum(mask: str) -> str:
    terms = [f"bit_count({restrict(mask, lo, hi)}) * {w!r}D" for lo, hi, w in STEP_WEIGHTS]
    return "(" + " + ".join(terms) + ")"


def _has(mask: str, day: int) -> str:
    return f"(({mask} & {1 << day}L) <> 0)"


# --- columns -----------------------------------------------------------------

def count_days(mask: str, lo: int = 1, hi: int = FEATURE_DAYS) -> Column:
    return F.expr(_count(mask, lo, hi))


def any_day(mask: str, lo: int, hi: int) -> Column:
    return F.expr(f"({restrict(mask, lo, hi)} <> 0)")


def is_empty(mask: str) -> Column:
    return F.expr(f"({mask} = 0)")


def last_day(mask: str) -> Column:
    """Highest set day, NULL for an empty set."""
    return F.expr(_last(mask))


def first_day(mask: str) -> Column:
    """Lowest set day, NULL for an empty set."""
    return F.expr(_first(mask))


def gaps(mask: str) -> Column:
    """Differences between consecutive set days (empty for < 2 days)."""
    return F.expr(_gaps(mask))


def gap_max(mask: str) -> Column:
    return F.expr(gap_max_sql(mask))


def gap_min(mask: str) -> Column:
    return F.expr(gap_min_sql(mask))


def gap_mean(mask: str) -> Column:
    """Mean gap = (last - first) / (days - 1); NULL for fewer than 2 days."""
    return F.expr(gap_mean_sql(mask))


def step_weight_sum(mask: str) -> Column:
    """Sum of step weights over the set days (one ``bit_count`` per weight band)."""
    return F.expr(_step_weight_sum(mask))


def cumulative_weight_sum(mask: str) -> Column:
    """Sum of W(day) over the set feature days."""
    table = "array(" + ", ".join(f"{float(v)!r}D" for v in CUMULATIVE_WEIGHTS) + ")"
    return F.expr(f"aggregate({_day_list(mask)}, 0D, "
                  f"(dl_acc, dl_d) -> dl_acc + element_at({table}, dl_d + 1))")


def weekly_pair(mask: str, day: int, lag: int = 7) -> Column:
    """Active on ``day`` and on ``day - lag``."""
    return F.expr(weekly_pair_sql(mask, day, lag))


def any_weekly_pair(mask: str, lo: int, hi: int, lag: int = 7) -> Column:
    """Active on some day d in ``lo..hi`` and on d - lag."""
    return F.expr(any_weekly_pair_sql(mask, lo, hi, lag))


# Public SQL-text forms, for feature expressions written as SQL.
count_sql = _count
last_sql = _last
first_sql = _first
step_weight_sum_sql = _step_weight_sum


def any_day_sql(mask: str, lo: int, hi: int) -> str:
    return f"({restrict(mask, lo, hi)} <> 0)"


def gap_max_sql(mask: str) -> str:
    return f"array_max({_gaps(mask)})"


def gap_min_sql(mask: str) -> str:
    return f"array_min({_gaps(mask)})"


def gap_mean_sql(mask: str) -> str:
    n = _count(mask)
    return f"(CASE WHEN {n} >= 2 THEN ({_last(mask)} - {_first(mask)}) / ({n} - 1) END)"


def weekly_pair_sql(mask: str, day: int, lag: int = 7) -> str:
    return f"({_has(mask, day)} AND {_has(mask, day - lag)})"


def any_weekly_pair_sql(mask: str, lo: int, hi: int, lag: int = 7) -> str:
    return f"(({mask} & shiftleft({mask}, {lag}) & {bits(lo, hi)}L) <> 0)"
