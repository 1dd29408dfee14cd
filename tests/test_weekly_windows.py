"""Eight weekly windows over logs that hold all of their days: 65 feature days and 7 label days."""

import datetime as dt
import random

import pytest

import __spark_entry__ as entry
from compare import compare, duck

@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Events of 80 days, in the shape of the benchmark tables."""
    rng, first = random.Random(5), dt.datetime(2024, 1, 1)
    root = str(tmp_path_factory.mktemp("days"))
    users = list(range(1, 41))
    spark.createDataFrame([(u, u % 25) for u in users], "c_custkey long, c_nationkey int").coalesce(1).write.parquet(f"{root}/customer")
    rows = [(rng.choice(users), first + dt.timedelta(days=rng.randrange(80), seconds=rng.randrange(86400)),
             rng.choice(["view", "view", "purchase", "click", "error", "signup"]), f'{{"k": {rng.randrange(120)}}}') for _ in range(3000)]
    spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string, props string").coalesce(1).write.parquet(f"{root}/events")
    return root


def test_windows_beyond_a_month_have_their_days(spark, sf_dir, tmp_path):
    import glob
    import os
    for name in ("customer", "events"):
        os.symlink(glob.glob(f"{sf_dir}/{name}/*.parquet")[0], tmp_path / f"{name}.parquet")
    root = str(tmp_path)
    r = compare(spark, root, "weekly_windows", entry.queries()["weekly_windows"], entry.oracle_sql()["weekly_windows"], duck(root))
    assert r["match"] and r["spark_rows"] > 8 * 30, r
    last = entry.queries()["weekly_windows"](spark, root).where("window_id = 8").selectExpr("sum(video_operate_times)", "sum(label)").first()
    assert last[0] > 0 and last[1] > 0
