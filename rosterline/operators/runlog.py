"""An append-only log of runs: what began, every page that came, how it ended."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rosterline.schemas import INGESTION_RUNS, RUN_EVENTS
from rosterline.sinks.tables import append

START, PAGE, SUCCESS, FAIL = "START", "PAGE", "SUCCESS", "FAIL"
NOTE_CHARS = 1000


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    """Events below ``path``, in the layout RUN_EVENTS. ``clock`` gives the time of an event."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], datetime] = utc_now) -> None:
        self.spark, self.path, self.clock = spark, path, clock

    def _event(self, step: "Step", event: str, records: int | None = None, notes: str | None = None) -> None:
        values = (step.run_id, step.source, step.entity, event, self.clock(), None, None, None, records, notes)
        append(self.spark.createDataFrame([values], RUN_EVENTS).coalesce(1), self.path)

    @contextmanager
    def step(self, run_id: str, source: str, entity: str) -> Iterator["Step"]:
        """One START, then SUCCESS with the rows that the step stored, or FAIL with what it raised, which goes on."""
        step = Step(self, run_id, source, entity)
        self._event(step, START)
        try:
            yield step
        except BaseException as problem:
            self._event(step, FAIL, step.rows, f"{type(problem).__name__}: {problem}"[:NOTE_CHARS])
            raise
        self._event(step, SUCCESS, step.rows)

    def events(self) -> DataFrame:
        return self.spark.read.schema(RUN_EVENTS).parquet(self.path)


class Step:
    """A step under way. Its rows are counted while they are written, never by a second pass."""

    def __init__(self, log: RunLog, run_id: str, source: str, entity: str) -> None:
        self.log, self.run_id, self.source, self.entity, self.rows = log, run_id, source, entity, 0

    def stores(self, df: DataFrame, write: Callable[[DataFrame], None]) -> None:
        """Writes a table and adds the rows that went by to the step's count."""
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.rows += seen.get["rows"]

    def pages(self, counts: DataFrame) -> None:
        """One PAGE event for each row of (scope, batch_id, page_seq, records)."""
        events = counts.select(
            F.lit(self.run_id).alias("run_id"), F.lit(self.source).alias("source"), F.lit(self.entity).alias("entity"),
            F.lit(PAGE).alias("event"), F.lit(self.log.clock()).cast("timestamp_ntz").alias("at"),
            "scope", "batch_id", "page_seq", "records", F.lit(None).cast("string").alias("notes"),
        )
        append(events, self.log.path)


def runs_of_events(events: DataFrame) -> DataFrame:
    """The run record of every step, in the layout INGESTION_RUNS; one that has not ended is RUNNING."""
    ended = F.col("event").isin(SUCCESS, FAIL)
    last = F.max(F.when(ended, F.col("event")))
    runs = events.groupBy("run_id", "source", "entity").agg(
        F.when(last == SUCCESS, "SUCCESS").when(last == FAIL, "FAILED").otherwise("RUNNING").alias("status"),
        F.min(F.when(F.col("event") == START, F.col("at"))).alias("started_at"), F.max(F.when(ended, F.col("at"))).alias("ended_at"),
        F.coalesce(F.max(F.when(ended, F.col("records"))), F.lit(0)).cast("bigint").alias("rows_ingested"),
        F.max(F.when(ended, F.col("notes"))).alias("notes"),
    )
    return runs.select(*[part.split()[0] for part in INGESTION_RUNS.split(", ")])
