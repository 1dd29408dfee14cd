"""Stored day counts, bucketed blocks, windows from a table, chunked author lists, one registration per user."""

import random
import re
import shutil
from dataclasses import replace

import pytest

from dayloom.operators.popularity import user_author_chunks
from dayloom.operators.windows import FeatureWindow, STANDARD_WINDOWS
from dayloom.plans.features import feature_table
from dayloom.plans.rollup import add_days, bucketed, launches_of_stored_windows, read_day_counts, store_windows
from dayloom.sources.logs import logs_from_frames, read_parquet_logs, write_parquet_logs

from test_plans import final_plan

WEEKLY = [FeatureWindow(k + 1, 1 + 7 * k, 16 + 7 * k, True) for k in range(8)]
DAYS = 80


@pytest.fixture(scope="module")
def logs(spark):
    """Logs of 80 days; user 1 has a third of the rows, user 30 none, some videos and authors are null."""
    rng = random.Random(3)

    def user():
        return 1 if rng.random() < 1 / 3 else rng.randrange(2, 30)

    def day():
        return rng.randrange(1, DAYS + 1)

    activity = [(user(), day(), rng.randrange(5), *((-1, -1) if rng.random() < 0.1 else (v, v % 7)), rng.randrange(6))
                for v in (rng.randrange(40) for _ in range(2500))]
    found = logs_from_frames(
        spark, [(u, rng.randrange(1, 70), rng.choice([0, 2, 10]), u % 5) for u in range(1, 31)],
        [(user(), day()) for _ in range(800)], [(user(), day()) for _ in range(300)], activity)
    return replace(found, activity=found.activity.selectExpr(
        "user_id", "day", "page", "nullif(video_id, -1) AS video_id", "nullif(author_id, -1) AS author_id", "action_type"))


def same(a, b):
    assert a.columns == b.columns
    found, wanted = ({(r["window_id"], r["user_id"]): r for r in x.collect()} for x in (a, b))
    assert found.keys() == wanted.keys() and found
    for key, row in wanted.items():
        blank = [x is None for x in row]
        assert [x is None for x in found[key]] == blank, key
        assert [x or 0 for x in found[key]] == pytest.approx([x or 0 for x in row], rel=1e-9, abs=1e-9), key


@pytest.mark.parametrize("mode", ["as_computed", "intended"])
def test_weeks_added_one_by_one_equal_the_full_run(spark, logs, tmp_path, mode):
    """Every load but the last is followed by the loss of the raw days it read."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "days")
    write_parquet_logs(logs, raw)
    loads = [(1, 23), (24, 30), (31, 58), (59, DAYS)]
    for first, last in loads:
        add_days(read_parquet_logs(spark, raw), root, first, last)
        for log in ("launch", "create", "activity"):
            for d in range(first, last + 1):
                shutil.rmtree(f"{raw}/{log}/day={d}", ignore_errors=True)
    same(feature_table(read_day_counts(spark, root), WEEKLY, mode), feature_table(logs, WEEKLY, mode))


def test_a_week_reads_its_own_days(spark, logs, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "days")
    write_parquet_logs(logs, raw)
    stored = read_parquet_logs(spark, raw)
    plan = stored.activity.where("day BETWEEN 24 AND 30")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 24[^\]]*day#\d+ <= 30", plan)
    add_days(stored, root, 1, DAYS)
    table = feature_table(read_day_counts(spark, root), [WEEKLY[3]], categories=[])
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", table._jdf.queryExecution().executedPlan().toString())
    assert sum(">= 22" in s for s in scans) >= 4  # launches, creations, activity, items


def test_adding_days_again_replaces_them(spark, logs, tmp_path):
    root = str(tmp_path / "days")
    for first, last in ((1, 40), (24, 30), (41, DAYS), (24, 30)):
        add_days(logs, root, first, last)
    same(feature_table(read_day_counts(spark, root), WEEKLY), feature_table(logs, WEEKLY))


def test_empty_logs_give_empty_counts(spark, tmp_path):
    root = str(tmp_path / "days")
    empty = logs_from_frames(spark, [], [], [], [])
    add_days(empty, root, 1, 7)
    assert feature_table(read_day_counts(spark, root), STANDARD_WINDOWS, categories=[]).count() == 0


def test_bucketed_blocks_join_without_exchange(spark, logs, tmp_path):
    table = feature_table(logs, STANDARD_WINDOWS, place=bucketed(spark, str(tmp_path / "blocks")))
    plan = final_plan(spark, table)
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    same(table, feature_table(logs, STANDARD_WINDOWS))


def test_windows_of_a_table_prune_the_days(spark, logs, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "windows")
    write_parquet_logs(logs, raw)
    store_windows(spark, WEEKLY, path)
    found = launches_of_stored_windows(read_parquet_logs(spark, raw).launch, spark.read.parquet(path).where("window_id = 2"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruning", plan)
    wanted = {(2, r["user_id"], r["day"] - 7) for r in logs.launch.collect() if 8 <= r["day"] <= 23}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == wanted


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_author_lists_in_chunks(spark, logs, chunk):
    rows = user_author_chunks(logs.activity, STANDARD_WINDOWS, chunk).collect()
    found = [(r["window_id"], r["user_id"], a) for r in rows for a in r["authors"]]
    wanted = {(w.window_id, r["user_id"], r["author_id"]) for r in logs.activity.collect() for w in STANDARD_WINDOWS
              if w.feat_begin <= r["day"] <= w.feat_end and r["author_id"] is not None}
    assert len(found) == len(set(found)) and set(found) == wanted
    assert all(list(r["authors"]) == sorted(r["authors"]) for r in rows)
    if chunk == 1000:
        assert {r["chunk"] for r in rows} == {0}


def test_a_hot_user_gets_many_lists_of_about_the_size(spark):
    activity = spark.range(20_000).selectExpr("7L AS user_id", "1 AS day", "0 AS page", "id AS video_id", "id AS author_id", "0 AS action_type")
    sizes = [len(r["authors"]) for r in user_author_chunks(activity, STANDARD_WINDOWS[:1], 500).collect()]
    assert len(sizes) == 40 and sum(sizes) == 20_000 and max(sizes) < 700


def test_a_second_registration_fails_the_job(spark, logs):
    user = logs.register.where("register_day <= 16").first()["user_id"]
    twice = replace(logs, register=logs.register.unionByName(logs.register.where(f"user_id = {user}")))
    with pytest.raises(Exception, match=f"user {user} is registered more than once"):
        feature_table(twice, STANDARD_WINDOWS).collect()
    late = logs.register.where(f"user_id = {user}").withColumn("register_day", logs.register.register_day * 0 + 79)
    twice = replace(logs, register=logs.register.unionByName(late))
    assert feature_table(twice, STANDARD_WINDOWS).count() > 0  # outside the windows' spine: no row is multiplied
