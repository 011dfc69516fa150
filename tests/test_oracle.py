"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_check import compare, connect

QUERIES = entry.library_queries()
ORACLE = entry.oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date" and len(df.columns) == 14
    assert df.count() == 30
