"""Hand-computed edge users (window 1, days 1-16)."""

import pytest

from dayloom.operators.windows import STANDARD_WINDOWS, window
from dayloom.plans.features import feature_table
from dayloom.sources.logs import logs_from_frames

W1 = [window(STANDARD_WINDOWS, 1)]


@pytest.fixture(scope="module")
def table(spark):
    logs = logs_from_frames(
        spark,
        register=[(1, 1, 0, 10), (2, 16, 1, 11), (3, 5, 0, 12), (4, 20, 1, 13), (5, 10, 2, 14)],
        launch=[(1, 2), (1, 9), (1, 9), (1, 16), (2, 16), (3, 20), (4, 10)],
        create=[(1, 3), (1, 16), (1, 16)],
        activity=[(4, 10, 0, 9, 2, 0), (5, 12, 1, 7, 1, 3), (5, 12, 1, 8, 1, 3)],
    )
    rows = feature_table(logs, W1).collect()
    return {r.user_id: r.asDict() for r in rows}


def close(a, b):
    return abs(a - b) < 1e-6


def test_spine(table):
    assert sorted(table) == [1, 2, 3, 5]          # user 4 registers after the window
    assert table[1]["register_day_distance"] == 16
    assert table[2]["register_day_distance"] == 1
    assert table[5]["register_type2"] == 1 and table[5]["register_type0"] == 0


def test_user1_launch_and_creation(table):
    u = table[1]
    assert (u["diff_day_max"], u["diff_day_min"], u["diff_day_mean"]) == (7, 7, 7)
    assert u["user_launch_last_day_distance"] == 1
    assert [u[f"app_launch{i}_day_before_rate"] for i in (2, 4, 7, 9)] == [1, 1, 1, 2]
    assert u["cycle_user"] == 1 and u["cycle_week_user"] == 0
    assert close(u["user_launch_date_occupied_avg"], 2.230769)
    assert u["create_video_diff_day_max"] == 13
    assert u["user_video_create_latest_day_distance"] == 1
    assert u["user_video_create_latest_day_num"] == 2
    assert (u["user_video_create_day_max"], u["user_video_create_day_min"],
            u["user_video_create_day_mean"]) == (2, 1, 1.5)
    assert u["video_create2_day_before_sum"] == 1
    assert close(u["video_create2_day_sum_weight"], 1.333333)
    assert close(u["video_create2_day_occupy"], 0.666667)
    assert u["video_create2_num_day"] == 0.5
    assert u["video_create_avg"] == 0.1875
    assert u["user_create_video_day_num_occupy"] == 0.125
    assert close(u["user_video_create_day_occupy_rate"], 0.261538)
    assert close(u["weight_create_count_rate"], 0.507692)
    assert u["user_is_author"] == 1 and u["label"] == 0


def test_user2_last_day_registration(table):
    u = table[2]
    assert u["diff_day_max"] == 17
    assert [u[f"app_launch{i}_day_before_rate"] for i in (2, 4, 7, 9)] == [1, 1, 1, 1]
    assert u["user_launch_date_occupied_avg"] == 4.0625
    assert u["user_is_author"] == 1 and u["label"] == 0


def test_user3_inactive_with_label(table):
    u = table[3]
    assert u["register_day_distance"] == 12
    assert u["user_launch_last_day_distance"] == 0        # not filled with 17
    for c in ("diff_day_max", "create_video_diff_day_mean", "user_video_create_latest_day_distance",
              "operate_video_distance_day", "user_activity_diff_day_max",
              "day_distance_to_operate_page0", "day_distance_to_operate_action_type5"):
        assert u[c] == 17, c
    assert u["video_operate_times"] == 0 and u["author_atttractive_force"] == 0
    assert u["label"] == 1


def test_user5_activity(table):
    u = table[5]
    assert (u["user_activity_diff_day_max"], u["user_activity_diff_day_min"],
            u["user_activity_diff_day_mean"]) == (0, 0, 0)
    assert close(u["video_operate_times"], 2 / 7)
    for s in ("max", "min", "mean", "median"):
        assert u[f"user_operate_video_day_{s}"] == 2
    assert u["user_operate_video_day_std"] == 0 and u["user_operate_video_day_var"] == 0
    assert u["operate_video_distance_day"] == 5
    assert u["user_operate_video_weight"] == 0.25
    assert close(u["author_atttractive_force"], 1 / 30)
    assert close(u["operate_video_day_occupy"], 0.076923)
    assert u["weight_user_view_video_weight"] == 0.125
    assert u["user_view_same_author_weight"] == 0.125
    assert u["last_day_operate_page1_times"] == 2
    assert u["day_distance_to_operate_page1"] == 5
    assert u["day_distance_to_operate_action_type3"] == 5
    assert u["day_distance_to_operate_page0"] == 17
    assert u["label"] == 0


def test_popularity_tie_breaks_by_author_id(spark):
    from dayloom.operators.popularity import author_views, top_authors
    from dayloom.sources.schemas import ACTIVITY
    rows = [(100 + a, 5, 0, a, a, 0) for a in range(31, 0, -1)]    # 31 authors, 1 view each
    df = spark.createDataFrame(rows, ACTIVITY)
    top = top_authors(author_views(df, W1)).collect()
    assert sorted(r.author_id for r in top) == list(range(1, 31))


def test_even_count_median(spark):
    from dayloom.operators.activity import activity_block
    from dayloom.sources.schemas import ACTIVITY
    rows = [(1, 3, 0, 1, 1, 0), (1, 4, 0, 1, 1, 0), (1, 4, 0, 2, 1, 0)]
    df = spark.createDataFrame(rows, ACTIVITY)
    r = activity_block(df, W1).first()
    assert r.act_median == 1.5


def test_window2_registration_cap(spark):
    logs = logs_from_frames(spark, register=[(1, 1, 0, 0)], launch=[], create=[], activity=[])
    r = feature_table(logs, [window(STANDARD_WINDOWS, 2)]).first()
    assert r.register_day_distance == 17
