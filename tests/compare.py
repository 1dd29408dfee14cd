"""Run a registered Spark query and its DuckDB oracle side by side.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t
    out = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(spark_s, 2)}
    if sql is None:
        out["match"] = None
        return out
    con = con or duck(sf_dir)
    t = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    out["duck_sec"] = round(time.time() - t, 2)
    if sorted(s_cols) != sorted(d_cols):
        out["match"] = False
        out["why"] = f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))[:5]} " \
                     f"duck-only {sorted(set(d_cols) - set(s_cols))[:5]}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = a == b
    if a != b:
        cols = sorted(s_cols)
        diff_cols = set()
        sa, sb = set(a), set(b)
        only_a = [r for r in a if r not in sb][:3]
        only_b = [r for r in b if r not in sa][:3]
        for ra, rb in zip(only_a, only_b):
            for c, x, y in zip(cols, ra, rb):
                if x != y:
                    diff_cols.add((c, x, y))
        out["why"] = f"{len([r for r in a if r not in sb])} rows differ; e.g. " \
                     f"{sorted(diff_cols, key=str)[:8]}"
    return out


def main(argv):
    import __spark_entry__ as entry
    from dayloom.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"query": name, "match": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("match") is False
        print(r, flush=True)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
