"""Every registered query against its DuckDB twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import duck, rows_of_duck, rows_of_spark
from checks.registry import queries
from checks.sql import oracle_sql

@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf_dir, name):
    columns, rows = rows_of_spark(queries()[name](spark, sf_dir))
    assert rows
    want_columns, want = rows_of_duck(con, oracle_sql()[name])
    assert columns == want_columns
    assert rows == want


def test_entry_lists_these_queries():
    assert set(entry_point.queries()) >= set(queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert entry_point.queries().keys() >= entry_point.oracle_sql().keys()
