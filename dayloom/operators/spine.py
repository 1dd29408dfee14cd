"""The per-window user spine: one row per user registered by the window end.

Columns: ``window_id, user_id, register_day_distance`` (age, capped at 17),
``device_type``, the one-hot ``register_type0..K-1`` and ``register_day_count``
(= W(age), the weighted exposure used as a denominator).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weights import cumulative_weight
from .windows import FeatureWindow, spine_windows

def register_type_categories(register: DataFrame) -> list:
    """Categories of ``register_type`` over the whole registration log,
    ordered as strings ("10" sorts before "2"), as the one-hot columns are
    named by that ordinal; null is none.  Each category is a column of the
    result, so the list is as long as the table is wide; a caller with a code
    table passes that list instead.
    """
    rows = register.select("register_type").where(F.col("register_type").isNotNull()).distinct().collect()
    return sorted((r[0] for r in rows), key=str)


def one_hot(value: str, categories: Sequence, prefix: str) -> list[Column]:
    """One 0/1 column per category, named by the category's ordinal; a null value is 0 in all."""
    return [F.col(value).eqNullSafe(F.lit(v)).cast("int").alias(f"{prefix}{i}")
            for i, v in enumerate(categories)]


def user_spine(register: DataFrame, windows: Sequence[FeatureWindow],
               categories: Sequence[int], once: bool = False) -> DataFrame:
    tagged = spine_windows(register, windows)
    if once:
        tagged = registered_once(tagged)
    return tagged.select(
        "window_id", "user_id", "register_day_distance", "device_type",
        *one_hot("register_type", categories, "register_type"),
        cumulative_weight(F.col("register_day_distance")).alias("register_day_count"),
    )


def registered_once(tagged: DataFrame) -> DataFrame:
    """One row per (window, user); the job fails with the user's id if there are two.

    The check rides on an aggregate by the key that the feature blocks are joined on, so its
    exchange is the join's and no second job runs.  It is carried by the registration
    age: a plan that never reads that column does not check.  A null id is one user.
    """
    keys = ["window_id", "user_id"]
    rest = [c for c in tagged.columns if c not in keys]
    told = "CAST(raise_error(concat('user ', user_id, ' is registered more than once')) AS INT)"
    return (tagged.groupBy(*keys).agg(F.count("*").alias("times"), *[F.any_value(c).alias(c) for c in rest])
            .withColumn("register_day_distance",
                        F.expr(f"CASE WHEN times > 1 AND user_id IS NOT NULL THEN {told} ELSE register_day_distance END"))
            .select(*keys, *rest))


def duplicate_users(register: DataFrame) -> DataFrame:
    """``(user_id, registrations)`` for ids registered more than once.

    The spine assumes one registration per user (a duplicate would fan out
    every left join); this is the check, as one aggregate.
    """
    return (register.groupBy("user_id").agg(F.count("*").alias("registrations"))
            .where(F.col("registrations") > 1))
