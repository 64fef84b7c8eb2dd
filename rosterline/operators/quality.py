"""Quality checks, run log and progress counts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterline.operators.history import Validity
from rosterline.operators.keyed import HOT_ROWS, earlier_max, in_time_chunks, split_hot_keys
from rosterline.schemas import INGESTION_RUNS


class QualityError(ValueError):
    """Checks that were to hold did not."""


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each named rule, counted in one pass: (rule, violations)."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
    return counts.select(F.inline(rows))


def null_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows with a NULL key column, per table and column: (rule, violations)."""
    reports = [
        check_rules(df, {f"Null {column} in {table}": F.col(column).isNull() for column in columns})
        for table, (df, columns) in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def require(report: DataFrame) -> None:
    """Raises :class:`QualityError` naming the broken rules; the report has one row per rule."""
    broken = [row["rule"] for row in report.where("violations > 0").select("rule").collect()]
    if broken:
        raise QualityError("Data quality checks failed: " + "; ".join(sorted(broken)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def validity_violations(
    history: DataFrame, keys: list[str], validity: Validity = Validity(), minutes: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Broken history invariants: (rule, violations).

    Rules: a version ends after it starts, a version does not start before every earlier one
    has ended, a current version has no end, and a key has at most one current version. A
    version that overlaps several earlier ones counts once.
    Keys with more than ``hot_rows`` versions are compared in chunks of ``minutes`` by start.
    Rows with a NULL key are left to :func:`null_keys`, NULL starts to :func:`check_rules`.
    """
    start, end, current = validity.columns
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    rows = split_hot_keys(
        history.where(whole).select(*keys, start, end, current), keys, in_time_chunks(history, start, minutes), hot_rows
    )
    # A version without an end never ends.
    never = F.lit("9999-12-31 23:59:59").cast(history.schema[end].dataType)
    seen = earlier_max(rows, keys, [start, end], F.coalesce(end, never), "__earlier_end")
    overlaps = F.col("__earlier_end") > F.col(start)
    per_row = check_rules(
        seen,
        {
            "ends before it starts": F.col(end) <= F.col(start),
            "overlaps an earlier version": overlaps,
            "current with an end": F.col(current) & F.col(end).isNotNull(),
        },
    )
    doubles = duplicate_keys(history.where(current), keys).agg(F.count(F.lit(1)).alias("violations"))
    return per_row.unionByName(doubles.select(F.lit("more than one current").alias("rule"), "violations"))


def run_record(
    spark: SparkSession, run_id: str, source: str, entity: str, status: str, started_at: datetime,
    ended_at: datetime, rows: int = 0, notes: str | None = None,
) -> DataFrame:
    """One row of the run log, typed even when the notes are missing."""
    values = (run_id, source, entity, status, started_at, ended_at, rows, notes)
    return spark.createDataFrame([values], INGESTION_RUNS)


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs, failures, rows and last success per source and entity."""
    succeeded = F.col("status") == "SUCCESS"
    return runs.groupBy("source", "entity").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.sum(F.when(succeeded, F.col("rows_ingested")).otherwise(0)).alias("rows_ingested"),
        F.max(F.when(succeeded, F.col("ended_at"))).alias("last_success"),
    )


def batch_progress(status: DataFrame) -> DataFrame:
    """Progress of every batch of a page feed: its outcome, pages and records."""
    outcome = F.when(F.col("is_complete"), "SUCCESS").otherwise("FAIL")
    return status.select("scope", "batch_id", outcome.alias("event"), "pages", "records")
