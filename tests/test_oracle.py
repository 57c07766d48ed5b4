"""Every registered query against its SQL twin in DuckDB."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert "freshness_status" in df.columns
    assert df.count() > 0
