"""Run-to-completion streams: file ingest, and a change feed applied to a history."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import StructType

from rosterline.streaming.feed_store import FeedStore


def ingest_files(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str,
    partition_cols: list[str] = ("year", "month", "day"), file_format: str = "json",
    files_per_batch: int | None = None,
) -> None:
    """Stores every file of ``source`` once, then returns. A later run takes only new files.

    The checkpoint lies apart from the source. Rows get their source file and time of
    ingest. ``files_per_batch`` cuts a large backlog into several micro-batches.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source).select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingest_ts")
    )
    query = (
        rows.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_cols)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def follow_feed(
    spark: SparkSession, source: str, schema: StructType, store: FeedStore, checkpoint: str,
    ts: str, seq: str, removed: Column | None = None, file_format: str = "parquet",
) -> None:
    """Applies every newly landed file of a change feed to a stored history, then returns.

    Rows may arrive in any order. A micro-batch that the store holds already, as after a
    failure between its commit and the stream's, changes nothing.
    """
    query = (
        spark.readStream.format(file_format).schema(schema).load(source)
        .writeStream.foreachBatch(lambda batch, number: store.apply(number, batch, ts, seq, removed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
