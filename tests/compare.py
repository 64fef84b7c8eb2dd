"""Compares a Spark result with the rows DuckDB gives for the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def expected(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(got: tuple[list[str], Counter], want: tuple[list[str], Counter]) -> str | None:
    """A short account of how two results differ, or None."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra, missing = got[1] - want[1], want[1] - got[1]
    return (
        f"{sum(got[1].values())} rows, want {sum(want[1].values())}; "
        f"extra {sum(extra.values())}: {list(extra)[:3]}; missing {sum(missing.values())}: {list(missing)[:3]}"
    )
