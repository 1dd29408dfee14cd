"""Recency weights, registration age, exposure caps and rates (scalar columns).

Days are *window days*: every feature window is re-based so that its last
feature day is day 16 and "today" is day 17 (see ``operators.windows``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for identical features) --------
CURRENT_DAY = 17          # first day after the 16-day feature window
FEATURE_DAYS = 16         # window days 1..16
LABEL_DAYS = 7            # window days 17..23 decide the label
AGE_CAP = 17              # registration age is capped at 17 days
MISSING_DISTANCE = 17     # fill for recency / gap features of inactive users
HORIZONS = (2, 4, 7, 9)   # trailing horizons, in days before day 17
TOP_AUTHORS = 30          # size of the popular-author list
# Step weight of a window day: day 16 -> 1/2, 13-15 -> 1/4, 10-12 -> 1/8,
# 6-9 -> 1/16, 1-5 -> 1/32  (listed as (first_day, last_day, weight)).
STEP_WEIGHTS = (
    (16, 16, 0.5),
    (13, 15, 0.25),
    (10, 12, 0.125),
    (6, 9, 1 / 16),
    (1, 5, 1 / 32),
)
# -----------------------------------------------------------------------------


def step_weight_value(day: int) -> float:
    for lo, hi, w in STEP_WEIGHTS:
        if lo <= day <= hi:
            return w
    return STEP_WEIGHTS[-1][2]  # days before the window weigh like day 1


def cumulative_weight_value(n: int) -> float:
    """W(n): weight of the last ``n`` window days, counted back from day 16."""
    return sum(step_weight_value(FEATURE_DAYS - k) for k in range(n))


# W(0..17), used as a lookup array; all entries are multiples of 1/32.
CUMULATIVE_WEIGHTS = tuple(cumulative_weight_value(n) for n in range(AGE_CAP + 1))


def step_weight(day: Column) -> Column:
    """Step weight of a window-day column (constant-folded ``CASE WHEN``)."""
    expr = None
    for lo, hi, w in STEP_WEIGHTS[:-1]:
        cond = day.between(lo, hi)
        expr = F.when(cond, F.lit(w)) if expr is None else expr.when(cond, F.lit(w))
    return expr.otherwise(F.lit(STEP_WEIGHTS[-1][2]))


def cumulative_weight(n: Column) -> Column:
    """W(n) for an integer column with values 0..17."""
    table = F.array(*[F.lit(float(v)) for v in CUMULATIVE_WEIGHTS])
    return F.element_at(table, n + 1)


def registration_age(register_day: Column, feat_end: Column | int) -> Column:
    """Days from registration to day 17, capped at 17 (1 for the last day)."""
    end = feat_end if isinstance(feat_end, Column) else F.lit(feat_end)
    return F.least(end + 1 - register_day, F.lit(AGE_CAP)).cast("int")


def age_cap(age: Column, horizon: int) -> Column:
    """Exposure in days within a trailing horizon: ``min(age, i)``."""
    return F.least(age, F.lit(horizon))


def weight_cap(age_weight: Column, horizon: int) -> Column:
    """Weighted exposure within a trailing horizon: ``min(W(age), W(i))``."""
    return F.least(age_weight, F.lit(cumulative_weight_value(horizon)))


def rate(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of raising on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# --- SQL-text forms (feature expressions are assembled as SQL) ----------------
AGE = "register_day_distance"        # spine column: capped registration age
AGE_WEIGHT = "register_day_count"    # spine column: W(age)


def rate_sql(numerator: str, denominator: str) -> str:
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def age_cap_sql(horizon: int) -> str:
    return f"least({AGE}, {horizon})"


def weight_cap_sql(horizon: int) -> str:
    return f"least({AGE_WEIGHT}, {cumulative_weight_value(horizon)!r}D)"


def step_weight_sql(day: str) -> str:
    """Step weight of a window-day expression (SQL ``CASE``)."""
    cases = " ".join(f"WHEN {day} BETWEEN {lo} AND {hi} THEN {w!r}D"
                     for lo, hi, w in STEP_WEIGHTS[:-1])
    return f"(CASE {cases} ELSE {STEP_WEIGHTS[-1][2]!r}D END)"


def zero_sql(expr: str) -> str:
    return f"coalesce({expr}, 0)"


def missing_distance_sql(expr: str) -> str:
    return f"coalesce({expr}, {MISSING_DISTANCE})"
