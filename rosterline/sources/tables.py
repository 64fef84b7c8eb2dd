"""Tables by path, by name, over JDBC, and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path_or_name: str, file_format: str | None = "parquet") -> DataFrame:
    """A stored table: by path when it holds a slash, else by catalog name."""
    if "/" in path_or_name:
        return spark.read.format(file_format).load(path_or_name)
    return spark.table(path_or_name)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A database table, read in ``partitions`` ranges of the numeric ``column``.

    Without a column it is one task, which only suits small dimension tables. The rows
    outside ``bounds`` are read too; bounds only set the stride.
    """
    properties = {"fetchsize": "10000", **(properties or {})}
    if column is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    low, high = bounds if bounds else (0, 1)
    return spark.read.jdbc(
        url=url, table=table, column=column, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=properties,
    )


def read_report(spark: SparkSession, path: str, report_schema: StructType) -> DataFrame:
    """Report CSV files with a header, plain or gzip, with or without a byte-order mark.

    A gzip file is not splittable: one file is one task, so parallelism is the number of
    report files.
    """
    return (
        spark.read.schema(report_schema)
        .option("header", True).option("multiLine", False).option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
