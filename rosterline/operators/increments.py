"""Incremental control: marks per scope, commits after the data, refresh of changed keys."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterline.operators.history import upsert_state
from rosterline.operators.runlog import Step
from rosterline.schemas import LANDED_MARKS, empty_table
from rosterline.sinks.tables import read_version, replace_partitions, write_version
from rosterline.sources.pages import batch_status, flatten_pages, page_counts, read_pages
from rosterline.workspace import child_names, committed_children, sized


def above_mark(feed: DataFrame, marks: DataFrame, scope: str, seq: str, mark: str = "mark") -> DataFrame:
    """Rows beyond their scope's mark; a scope without a mark is read from the beginning."""
    joined = feed.join(marks.select(scope, F.col(mark).alias("__mark")), scope, "left")
    return joined.where(F.col("__mark").isNull() | (F.col(seq) > F.col("__mark"))).drop("__mark")


def next_marks(marks: DataFrame, taken: DataFrame, scope: str, seq: str, mark: str = "mark") -> DataFrame:
    """Marks after ``taken`` was stored; they never go back."""
    reached = taken.groupBy(scope).agg(F.max(seq).alias(mark))
    return marks.select(scope, mark).unionByName(reached).groupBy(scope).agg(F.max(mark).alias(mark))


def commit_tokens(tokens: DataFrame, status: DataFrame, baseline: datetime | None = None) -> DataFrame:
    """Resume tokens after the complete batches of ``status``; an unfinished batch changes none.

    ``tokens`` has the layout CHANGE_MARKS; ``baseline`` is the snapshot time a seed started from.
    """
    since = F.lit(baseline.isoformat(sep=" ") if baseline else None).cast("timestamp_ntz")
    finished = status.where("is_complete").select(
        "scope", "delta_link", F.col("received_ts").alias("last_success_ts"), since.alias("snapshot_filter_from"),
        "batch_id",
    )
    return upsert_state(tokens, finished, ["scope"], ["last_success_ts", "batch_id"])


def unread_batches(spark: SparkSession, landing: str, marks: dict[str, str]) -> list[str]:
    """Folders ``scope=.../batch_id=...`` of batches above their scope's mark.

    Only folder names are looked at, on the driver: one per scope, and one per batch of a scope.
    Batch names of a scope ascend as text.
    """
    found = []
    for scope in child_names(spark, landing, "scope="):
        mark = marks.get(unquote(scope.removeprefix("scope=")), "")
        for batch in child_names(spark, f"{landing}/{scope}", "batch_id="):
            if unquote(batch.removeprefix("batch_id=")) > mark:
                found.append(f"{landing}/{scope}/{batch}")
    return found


def landed_marks(spark: SparkSession, marks_base: str) -> DataFrame:
    """The stored mark and resume token of every scope."""
    if committed_children(spark, marks_base, "version="):
        return read_version(spark, marks_base)
    return empty_table(spark, LANDED_MARKS)


def land_batches(
    spark: SparkSession, landing: str, record: str, rows: Callable[[DataFrame], DataFrame], rows_path: str,
    marks_base: str, baseline: datetime | None = None, log: Step | None = None,
) -> DataFrame | None:
    """Stores the records of newly finished batches, and only then their marks and resume tokens.

    Batches at or below their scope's mark are not opened. ``rows`` turns flattened records
    into the rows to store and keeps ``scope`` and ``batch_id``. A batch that is not
    finished waits; once a later one of its scope is, it was given up and is left out, as
    the later one began at the same token. A failure before the marks leaves the old
    ones, and the repeated run replaces the same batches: nothing is lost or doubled.
    Gives the pages that were read, or None when nothing is new.
    """
    marks = landed_marks(spark, marks_base)
    held = {r["scope"]: r["batch_id"] or "" for r in marks.select("scope", "batch_id").collect()}  # one row per scope
    paths = unread_batches(spark, landing, held)
    if not paths:
        return None
    pages = read_pages(spark, paths, record, base=landing)
    if log:
        log.pages(page_counts(pages))
    taken = rows(flatten_pages(pages))
    store = lambda df: replace_partitions(df, rows_path, ["scope", "batch_id"])
    log.stores(taken, store) if log else store(taken)
    since = F.lit(baseline.isoformat(sep=" ") if baseline else None).cast("timestamp_ntz")
    finished = batch_status(pages).where("is_complete").select(
        "scope", "delta_link", F.col("received_ts").alias("last_success_ts"), since.alias("snapshot_filter_from"), "batch_id"
    )
    write_version(upsert_state(marks, finished, ["scope"], ["batch_id"]), marks_base)
    return pages


def latest_batch_keys(feed: DataFrame, key: str, batch: str = "delta_batch_id", received: str = "received_ts") -> DataFrame:
    """Distinct keys of the batch that was received last (by time, not by the batch's name)."""
    newest = feed.agg(F.max_by(batch, F.struct(received, batch))).scalar()
    return feed.where(F.col(batch) == newest).select(key).distinct()


def refresh_children(children: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Child rows of the changed keys."""
    return children.join(sized(changed.select(key), "changed-keys"), key, "left_semi")


class BucketedChildren:
    """Child rows stored in folders by a hash of their parent's key, so that a refresh reads few of them.

    Within a folder rows are sorted by the key, so files and row groups outside the range of
    the changed keys are skipped too.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = f"{schema}, __bucket INT"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def store(self, children: DataFrame) -> None:
        """Replaces the buckets that occur in ``children`` by these rows."""
        rows = children.withColumn("__bucket", self._bucket())
        replace_partitions(rows.hint("rebalance", "__bucket").sortWithinPartitions("__bucket", self.key), self.path, ["__bucket"], rebalance=False)

    def of(self, changed: DataFrame) -> DataFrame:
        """Rows of the changed keys. The driver sees which buckets they lie in, and their least and greatest."""
        keys = sized(changed.where(F.col(self.key).isNotNull()).select(self.key).distinct().withColumn("__in", self._bucket()), "changed-keys")
        found = keys.agg(F.collect_set("__in").alias("buckets"), F.min(self.key).alias("low"), F.max(self.key).alias("high")).first()
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        rows = rows.where(F.col("__bucket").isin(found["buckets"]))
        if found["buckets"]:
            rows = rows.where(F.col(self.key).between(F.lit(found["low"]), F.lit(found["high"])))
        return rows.drop("__bucket").join(keys.select(self.key), self.key, "left_semi")
