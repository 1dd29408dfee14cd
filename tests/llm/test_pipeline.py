"""The pipeline's stages against brute force on a small table, and the whole on the test table."""

import random
import sys

import cases
import corpus_pipeline as cp
from conftest import SF_SMALL
from dayloom.llm import common, mixing, quality_rules, secret_scan
from test_operators import brute_components, brute_contamination, brute_fingerprint


def stage(spark, docs, n, folder=SF_SMALL):
    return cp.STAGES[n][1](spark, docs, folder)


def test_names():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "mixing sources to target weights"]


def test_stages_against_brute_force(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    bench = [(r["item_id"], r["text"]) for r in common.table(spark, SF_SMALL, "benchmark").collect()]

    now = stage(spark, docs, 0)
    judged = [(i, quality_rules.judge(t), s) for i, t, s in rows]
    rows = [(i, j[9], s) for i, j, s in judged if j[8]]
    assert now.columns == list(cp.COLUMNS)
    assert cases.rows_of(now.select("doc_id", "text", "source", "n_chars")) == sorted(((i, t, s, len(t)) for i, t, s in rows), key=repr)

    now = stage(spark, now, 1)
    groups = brute_components([brute_fingerprint(t) for _, t, _ in rows], 3)
    least: dict = {}
    for i, t, _ in rows:
        g = groups[brute_fingerprint(t)]
        least[g] = min(i, least.get(g, i))
    rows = [r for r in rows if r[0] in set(least.values())]
    assert cases.rows_of(now.select("doc_id", "text", "source")) == sorted(rows, key=repr)

    now = stage(spark, now, 2)
    bad = {r[0] for r in brute_contamination([r[:2] for r in rows], bench) if r[4]}
    assert bad
    rows = [r for r in rows if r[0] not in bad]
    assert cases.rows_of(now.select("doc_id", "text", "source")) == sorted(rows, key=repr)

    now = stage(spark, now, 3)
    scanner = secret_scan.Scanner(secret_scan.RULES)
    rows = [(i, secret_scan.redact(t, scanner.scan([t])[0]), s) for i, t, s in rows]
    assert any(secret_scan.REDACTED in t for _, t, _ in rows)
    assert cases.rows_of(now.select("doc_id", "text", "source", "n_chars")) == sorted(((i, t, s, len(t)) for i, t, s in rows), key=repr)

    mixed = stage(spark, now, 4).collect()
    sizes: dict = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted(sizes)
    wanted = mixing.targets([sizes[n] for n in names], [[5, 2, 1][k % 3] for k in range(len(names))], 3)
    taken: dict = {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + r["words"]
    assert taken == {n: int(w + 0.5) for n, w in zip(names, wanted) if int(w + 0.5)}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= {r[:2] for r in rows}


def test_run_twice(spark):
    a, b = (cases.rows_of(cp.run(spark, SF_SMALL)) for _ in range(2))
    assert a and a == b


def test_awkward_tables(spark):
    docs = cases.documents(spark, cases.awkward_rows())
    for n in range(5):
        for table in (docs, cases.clashing(docs), docs.limit(0)):
            out = stage(spark, table, n)
            out.collect()
            assert n == 4 or out.columns == list(cp.COLUMNS)


def test_clean_documents_stay(spark):
    rng = random.Random(3)
    rows = [(k, "\n".join(cases.sentences(1000 * k + j, 30).capitalize() + "." for j in range(4)), rng.choice("ab")) for k in range(40)]
    docs = cases.documents(spark, rows)
    for n in range(4):
        docs = stage(spark, docs, n)
    assert cases.rows_of(docs.select("doc_id", "text", "source")) == sorted(rows, key=repr)


def test_rest_works_without_the_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    root = os.path.dirname(os.path.abspath(cp.__file__))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'register_spine' in q; e.oracle_sql()"],
                          cwd=tmp_path / "repo", capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
