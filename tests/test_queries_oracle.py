"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); rows-only queries must run."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["status"] == "MATCH", r


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "produccion_tn" in df.columns


@pytest.mark.parametrize("name", ["yield_training_table", "yield_series_positions", "planner_feature_rows"])
def test_training_queries_match_where_the_table_has_rows(spark, name):
    """At sf0.001 no department has soil and all 14 months, so these are empty there."""
    d = "/root/testdata/sf0.01"
    r = compare(spark, duck(d), name, E.queries()[name], E.oracle_sql()[name], d)
    assert r["status"] == "MATCH" and r["spark_rows"] > 0, r
