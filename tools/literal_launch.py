"""A literal baseline: the launch block written one aggregate + one left join
per feature (the shape of the source job), timed against the bitmap block.

Usage: python tools/literal_launch.py [sf_dir]  ->  one JSON line.
Both variants produce the same 11 columns for window 1 (checked here).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dayloom.functions.weights import cumulative_weight  # noqa: E402
from dayloom.operators.launch import launch_block  # noqa: E402
from dayloom.operators.windows import STANDARD_WINDOWS  # noqa: E402
from dayloom.session import local_session  # noqa: E402
from dayloom.sources.logs import fixture_logs  # noqa: E402

W1 = STANDARD_WINDOWS[0]


def literal_launch(launch):
    """Window 1 only, one join per feature, as the source job does it."""
    b, e, slide = W1.feat_begin, W1.feat_end, W1.slide
    rows = launch.distinct().where(F.col("day").between(b, e))
    users = rows.select("user_id").distinct()
    out = users
    last = rows.groupBy("user_id").agg((17 - F.max(F.col("day") - slide))
                                       .alias("user_launch_last_day_distance"))
    out = out.join(last, "user_id", "left")
    gap = rows.withColumn("gap", F.col("day") - F.lag("day").over(
        Window.partitionBy("user_id").orderBy("day")))
    for name, fn in (("diff_day_max", F.max), ("diff_day_min", F.min), ("diff_day_mean", F.avg)):
        out = out.join(gap.groupBy("user_id").agg(fn("gap").alias(name)), "user_id", "left")
    for i in (2, 4, 7, 9):
        h = rows.where(F.col("day") - slide >= 17 - i).groupBy("user_id").agg(
            F.count("*").alias(f"app_launch{i}_day_before_rate"))
        out = out.join(h, "user_id", "left")
    latter = rows.where(F.col("day") == e).select("user_id")
    before = rows.where(F.col("day") == e - 7).select("user_id")
    cycle = latter.join(before, "user_id").distinct().withColumn("cycle_user", F.lit(1))
    out = out.join(cycle, "user_id", "left")
    wk1 = rows.where(F.col("day").between(e - 3, e - 2)).select("user_id").distinct()
    wk2 = rows.where(F.col("day").between(e - 10, e - 9)).select("user_id").distinct()
    week = wk1.join(wk2, "user_id").withColumn("cycle_week_user", F.lit(1))
    out = out.join(week, "user_id", "left")
    occ = rows.groupBy("user_id").agg(F.sum(cumulative_weight(F.col("day") - slide))
                                      .alias("user_launch_date_occupied"))
    return out.join(occ, "user_id", "left")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    launch = fixture_logs(spark, sf_dir).launch

    def timed(make, reps=3):
        best = None
        for _ in range(reps):
            t = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        return round(best, 3)

    ours = launch_block(launch, [W1]).where(
        F.col("user_launch_last_day_distance").isNotNull()).drop("label_launch", "window_id")
    lit = literal_launch(launch)
    cols = sorted(c for c in lit.columns)
    norm = lambda df: df.select([F.round(F.col(c).cast("double"), 9).alias(c) for c in cols]).na.fill(0)
    same = norm(ours).exceptAll(norm(lit)).count() == 0 and norm(lit).exceptAll(norm(ours)).count() == 0
    t_ours = timed(lambda: launch_block(launch, [W1]))
    t_lit = timed(lambda: literal_launch(launch))
    print(json.dumps({"sf_dir": sf_dir, "same_result": same, "bitmap_block_sec": t_ours,
                      "one_join_per_feature_sec": t_lit}))


if __name__ == "__main__":
    main(sys.argv)
