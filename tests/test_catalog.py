"""Every registered query against its SQL on the smallest tables."""

import pytest
from check import compare, sql_connection
from paths import SF

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return sql_connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, con):
    same, note = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert same, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(name, spark):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
