"""The scores come from a fit on both labelled windows, of the tuned number of rounds."""

from dataclasses import replace
from types import SimpleNamespace

from pyspark.sql import functions as F

from dayloom.plans import model as m
from dayloom.plans import queries

from conftest import SF_SMALL


def test_scores_use_both_labelled_windows(spark, monkeypatch):
    table = spark.createDataFrame([(w, u, d, float(u % 7), int(u % 7 > 3) if w < 3 else None) for w in (1, 2, 3) for u, d in zip(range(60), [3, 4] * 30)],
                                  "window_id int, user_id long, device_type int, video_operate_times double, label int")
    tuned = m.fit(table, [1], replace(m.TUNING, max_iter=3))
    asked, fit = [], m.fit

    def noted(rows, windows, cfg):
        asked.append((list(windows), cfg))
        return fit(rows, windows, cfg)

    monkeypatch.setattr(queries, "_tuned", lambda spark, sf_dir: (table, SimpleNamespace(**vars(tuned))))
    monkeypatch.setattr(m, "fit", noted)
    found = queries.score_check(spark, SF_SMALL)
    assert found.count() == 60 and found.where(~F.col("valid")).count() == 0
    assert asked == [([1, 2], replace(m.TUNING, max_iter=3))]
