"""Property checks over the sf0.01 feature table."""

import pytest
from pyspark.sql import functions as F

from dayloom.operators.activity import activity_block
from dayloom.operators.launch import AS_COMPUTED, INTENDED
from dayloom.operators.windows import STANDARD_WINDOWS
from dayloom.plans.features import feature_table
from dayloom.sources.logs import fixture_logs

from conftest import SF_CHECK

PAGES = [f"page{j}" for j in range(5)]
ACTIONS = [f"action_type{j}" for j in range(6)]


@pytest.fixture(scope="module")
def logs(spark):
    return fixture_logs(spark, SF_CHECK)


@pytest.fixture(scope="module")
def block(logs):
    return activity_block(logs.activity, STANDARD_WINDOWS).cache()


def test_category_rows_add_up(block):
    for group in (PAGES, ACTIONS):
        total = sum(F.coalesce(F.col(f"cat_{c}_rows"), F.lit(0)) for c in group)
        assert block.where(total != F.col("act_rows")).count() == 0


def test_order_statistics(block):
    for p in ["act"] + [f"cat_{c}" for c in PAGES + ACTIONS]:
        bad = block.where((F.col(f"{p}_median") > F.col(f"{p}_max")) |
                          (F.col(f"{p}_median") < 1))
        assert bad.count() == 0, p
    assert block.where((F.col("act_min") > F.col("act_median"))).count() == 0


def test_occupancy_bounded_by_exposure(logs):
    t = feature_table(logs, STANDARD_WINDOWS, categories=list(range(12)))
    # day-weight sums never exceed W(17) = 2.0625, so rates stay below 2.0625 / W(age)
    bad = t.where((F.col("operate_video_day_occupy") < 0) |
                  (F.col("user_launch_date_occupied_avg") < 0) |
                  (F.col("author_atttractive_force") > 1))
    assert bad.count() == 0


def test_modes_differ_only_in_intended_columns(logs):
    cats = list(range(12))
    a = feature_table(logs, STANDARD_WINDOWS, AS_COMPUTED, cats)
    b = feature_table(logs, STANDARD_WINDOWS, INTENDED, cats)
    changed = {"cycle_user", "cycle_user_create_video", "cycle_user_user_activity",
               "user_launch_date_occupied_avg", "label"} | \
              {f"app_launch{i}_day_before_rate" for i in (2, 4, 7, 9)}
    added = set(b.columns) - set(a.columns)
    assert added == {f"app_launch{i}_day_before_occupy" for i in (2, 4, 7, 9)} | \
        {f"user_operated_{c}_day_min" for c in PAGES + ACTIONS}
    same = [c for c in a.columns if c not in changed]
    assert a.select(*same).exceptAll(b.select(*same)).count() == 0
    # the intended cycle flag is a superset of the computed one
    j = a.select("window_id", "user_id", F.col("cycle_user").alias("c1")).join(
        b.select("window_id", "user_id", F.col("cycle_user").alias("c2")), ["window_id", "user_id"])
    assert j.where(F.col("c1") > F.col("c2")).count() == 0


def test_windows_in_one_job_equal_single_window_jobs(logs):
    cats = list(range(12))
    whole = feature_table(logs, STANDARD_WINDOWS, categories=cats)
    for w in STANDARD_WINDOWS:
        one = feature_table(logs, [w], categories=cats)
        part = whole.where(F.col("window_id") == w.window_id).select(*one.columns)
        r1 = part.select([F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in part.dtypes])
        r2 = one.select([F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in one.dtypes])
        assert r1.exceptAll(r2).count() == 0 and r2.exceptAll(r1).count() == 0
