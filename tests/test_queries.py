"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference, expected, rows_of
from rosterline.plans import all_queries, all_sql

QUERIES = all_queries()
ORACLE = all_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_reference_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    got = rows_of(result.columns, result.collect())
    assert difference(got, expected(connection, ORACLE[name])) is None


def test_entry_gives_entitlements(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "site_id", "resource_id", "resource_type", "role_definition_id", "user_object_id", "grant_type"
    ]
    assert result.count() == 109896
