"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

from conftest import SF_SMALL

SQL = entry.oracle_sql()
NAMES = [n for n in entry.queries() if n in SQL and n != "final_node_check"]  # all 1200 rounds: test_boosting runs it with fewer


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, entry.queries()[name], SQL[name], con)
    assert r["match"], r


def test_every_query_has_an_oracle_or_is_a_model_job():
    no_sql = set(entry.queries()) - set(SQL)
    no_sql = {n for n in no_sql if n != "pipeline" and not n.startswith("op")}  # tested in tests/llm
    assert no_sql <= {"gbt_auc", "gbt_importance", "gbt_scores",  # their properties have: auc_of_feature, importance_check, score_check
                      "final_scores", "final_importance", "tuning_curve", "parameter_search"}  # final_node_check; brute force in test_boosting


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns and "user_id" in df.columns
