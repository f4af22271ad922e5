"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entrypoint
from supplylens import registry
from tests.compare import database, differences

QUERIES, SQL = registry.queries(), registry.sql()


@pytest.fixture(scope="module")
def con(small):
    return database(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, small, name):
    assert differences(QUERIES[name](spark, small), con, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_returns_regions(spark):
    assert entrypoint.entry(spark).count() == 5
