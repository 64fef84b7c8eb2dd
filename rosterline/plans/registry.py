"""The named queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Build = Callable[[SparkSession, str], DataFrame]

BUILDS: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
    """Registers a query under its function name, with the SQL that must give the same rows."""

    def register(build: Build) -> Build:
        key = name or build.__name__
        BUILDS[key] = build
        if sql:
            SQL[key] = sql.strip()
        return build

    return register


_schemas: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file footer once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)
