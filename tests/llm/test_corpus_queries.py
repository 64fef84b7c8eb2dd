"""The corpus queries with SQL against DuckDB; the others are tested by brute force in their own files."""

import pytest
from compare import connect, difference, expected, rows_of

from rosterline.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    got = rows_of(result.columns, result.collect())
    assert difference(got, expected(connect(sf_dir), SQL[name])) is None


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
