"""Command line: the three jobs of the task.

  python -m dayloom features --logs parquet:/data/logs --out /data/features
  python -m dayloom train    --features /data/features --importances /data/imp
  python -m dayloom predict  --features /data/features --scores /data/scores

``--logs`` takes ``parquet:<root>`` (register/launch/create/activity folders),
``tsv:<root>`` (``user_register_log.txt`` ...) or ``fixture:<sf_dir>`` (views
over the benchmark tables).  On a cluster the session comes from the platform
(``spark-submit``); ``--local N`` starts a local session instead.
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import replace

from pyspark.sql import SparkSession

from .operators.launch import AS_COMPUTED, INTENDED
from .operators.windows import STANDARD_WINDOWS
from .plans import model as m
from .plans.features import feature_table
from .session import apply_engine_conf, ensure_checkpoint_dir, local_session
from .sources import sinks
from .sources.logs import fixture_logs, read_parquet_logs, read_tsv_logs

TSV_NAMES = {
    "register": "user_register_log.txt",
    "launch": "app_launch_log.txt",
    "create": "video_create_log.txt",
    "activity": "user_activity_log.txt",
}


def _session(args) -> SparkSession:
    if args.local:
        return local_session(args.local)
    spark = SparkSession.builder.getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _logs(spark, spec: str):
    kind, _, where = spec.partition(":")
    if kind == "parquet":
        return read_parquet_logs(spark, where)
    if kind == "tsv":
        return read_tsv_logs(spark, **{k: os.path.join(where, v) for k, v in TSV_NAMES.items()})
    if kind == "fixture":
        return fixture_logs(spark, where)
    raise SystemExit(f"unknown log source {spec!r}")


def cmd_features(args) -> None:
    spark = _session(args)
    table = feature_table(_logs(spark, args.logs), STANDARD_WINDOWS, mode=args.mode)
    if args.format == "csv":
        sinks.write_feature_csv(table, args.out)
    else:
        sinks.write_feature_table(table, args.out)


def _table(spark, path):
    return sinks.read_feature_table(spark, path)


def cmd_train(args) -> None:
    spark = _session(args)
    table = _table(spark, args.features)
    cfg = replace(m.TUNING, max_iter=args.rounds) if args.rounds else m.TUNING
    model = m.fit_with_patience(table, [1], 2, cfg)
    aucs = {r.window_id: r.auc for r in m.evaluate(model, table, [1, 2]).collect()}
    print(json.dumps({"auc": aucs}))
    sinks.write_importances(m.split_importances(model), args.importances)


def cmd_predict(args) -> None:
    spark = _session(args)
    table = _table(spark, args.features)
    cfg = replace(m.FINAL, max_iter=args.rounds) if args.rounds else m.FINAL
    model = m.fit(table, [1, 2], cfg)
    sinks.write_scores(m.score(model, table, 3), args.scores)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="dayloom")
    p.add_argument("--local", help="run on local[N] instead of the cluster session")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("features")
    f.add_argument("--logs", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    f.add_argument("--mode", choices=[AS_COMPUTED, INTENDED], default=AS_COMPUTED)
    f.set_defaults(fn=cmd_features)
    t = sub.add_parser("train")
    t.add_argument("--features", required=True)
    t.add_argument("--importances", required=True)
    t.add_argument("--rounds", type=int)
    t.set_defaults(fn=cmd_train)
    s = sub.add_parser("predict")
    s.add_argument("--features", required=True)
    s.add_argument("--scores", required=True)
    s.add_argument("--rounds", type=int)
    s.set_defaults(fn=cmd_predict)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
