"""Next-week activity label.

As computed, a user of a labelled window is positive when they launched the
app on one of the 7 days after the window (taken from the launch bitmap, see
``launch.launch_label``).  The ``intended`` variant counts any of the three
logs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.logs import Logs
from .windows import FeatureWindow, assign_label_days


def launch_labels(launch: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(window_id, user_id, label)`` for users who launched on a label day."""
    return (assign_label_days(launch.select("user_id", "day"), windows)
            .groupBy("window_id", "user_id").agg(F.lit(1).alias("label")))


def any_log_labels(logs: Logs, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(window_id, user_id, label)`` for users present in any log on a label day."""
    rows = None
    for log in (logs.launch, logs.create, logs.activity):
        part = assign_label_days(log.select("user_id", "day"), windows)
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("window_id", "user_id").agg(F.lit(1).alias("label"))
