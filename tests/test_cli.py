"""The three jobs end to end through the command line entry point."""

import uuid

from dayloom.__main__ import main
from dayloom.session import checkpoint_path

from conftest import SF_CHECK


def test_features_train_predict(spark):
    root = checkpoint_path(spark, f"cli_{uuid.uuid4().hex}")
    main(["--local", "*", "features", "--logs", f"fixture:{SF_CHECK}", "--out", f"{root}/features"])
    table = spark.read.parquet(f"{root}/features")
    assert table.count() == 3450
    assert {r.window_id for r in table.select("window_id").distinct().collect()} == {1, 2, 3}
    main(["--local", "*", "train", "--features", f"{root}/features",
          "--importances", f"{root}/imp", "--rounds", "3"])
    imp = spark.read.option("header", "true").csv(f"{root}/imp")
    assert imp.count() == len(table.columns) - 3       # all but window_id, user_id, label
    main(["--local", "*", "predict", "--features", f"{root}/features",
          "--scores", f"{root}/scores", "--rounds", "3"])
    scores = spark.read.schema("user_id long, predicted_score double").csv(f"{root}/scores")
    assert scores.count() == table.where("window_id = 3").count()
