"""Every registered query against its DuckDB twin (exact values) at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from tillcube import registry

# The forest-backed queries are checked in test_ml.py (rows-only there too).
HEAVY = {"rf_metrics", "score_requests", "prediction_log", "forest_scores", "prediction_log_rows"}
# Queries of the llm subpackage are tested in tests/llm.
NAMES = [n for n in registry.QUERIES if n not in HEAVY]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), sf_dir, con)
    assert r["status"] in ("ok", "rows-only"), r
    if name not in E.oracle_sql():
        assert r["rows"] > 0


def test_every_query_has_oracle_or_is_listed_rows_only():
    rows_only = set(registry.QUERIES) - set(E.oracle_sql())
    assert rows_only == {"lr_metrics", "rf_metrics", "score_requests", "prediction_log"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "category_name"
    assert df.count() > 0
