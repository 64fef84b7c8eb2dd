"""A stored history that follows a change feed batch by batch, in whatever order rows arrive.

The store keeps one row per key and time of change, with what follows from it: whether the
row opens a version, ends one or changes nothing, and when its version ends. Rows that change
nothing are kept, because a row that arrives late may give them meaning.

Rows lie in *parts*, cut by a hash of the key. A batch adds one part that holds only the rows it
brings or changes: the touched keys' stored rows and new ones are put in one order and
replayed in one pass, and what comes out as it was is not written. Reading takes every row from its newest part. When a level has ``fanout`` parts they
are merged into one part of the next level, which drops superseded rows; so a row is
rewritten once per level, and the folder follows the data. A part's name says which batches
it covers, and it counts once its job is committed: a reader sees the old parts or the merged
one, never both. Merged parts' sources are deleted when the next batch begins, so that a reader
that has listed them can finish.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from rosterline.operators.history import Validity
from rosterline.operators.keyed import HOT_ROWS, in_time_chunks, latest_per_key, split_hot_keys, with_neighbours
from rosterline.schemas import empty_table
from rosterline.workspace import committed_names, remove_tree, sized

VERSION, END, SILENT = "version", "end", "silent"


@dataclass(frozen=True)
class Part:
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"part-{self.level}-{self.first}-{self.last}"

    @classmethod
    def named(cls, name: str) -> "Part":
        return cls(*map(int, name.split("-")[1:]))

    def covers(self, other: "Part") -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


class FeedStore:
    """``keys`` and ``tracked`` are DDL column lists; ``carried`` columns are kept but not compared.

    Rows with a NULL key are left out. Of rows of a key at one time the one with the greatest
    ``seq`` counts, from whatever batch. ``buckets`` is fixed with the first batch.
    """

    def __init__(
        self, spark: SparkSession, base: str, keys: str, tracked: str = "", carried: str = "",
        buckets: int = 16, fanout: int = 4, ts_type: str = "TIMESTAMP_NTZ", hot_rows: int = HOT_ROWS,
    ) -> None:
        self.spark, self.base, self.buckets, self.fanout, self.hot_rows = spark, base, buckets, fanout, hot_rows
        names = lambda ddl: StructType.fromDDL(ddl).names if ddl else []
        self.keys, self.tracked, self.carried = names(keys), names(tracked), names(carried)
        given = ", ".join(ddl for ddl in (keys, tracked, carried) if ddl)
        self.schema = StructType.fromDDL(
            f"{given}, `__ts` {ts_type}, `__seq` BIGINT, `__gone` BOOLEAN, `__kind` STRING, `__until` {ts_type}, `__batch` BIGINT, `__bucket` INT"
        )

    # --- parts ---------------------------------------------------------------------------

    def _all_parts(self) -> list[Part]:
        return [Part.named(name) for name in committed_names(self.spark, self.base, "part-")]

    def parts(self) -> list[Part]:
        """The parts that make up the store: those that no merged part covers."""
        parts = self._all_parts()
        return sorted((p for p in parts if not any(q.covers(p) for q in parts)), key=lambda p: p.first)

    def holds(self, number: int) -> bool:
        """Whether a batch is part of the store."""
        return any(p.first <= number <= p.last for p in self.parts())

    def _read(self, parts: list[Part], buckets: list[int] | None = None) -> DataFrame:
        if not parts:
            return empty_table(self.spark, self.schema)
        paths = [f"{self.base}/{p.name}" for p in parts]
        # One folder per bucket and part; the bucket is a folder name, so others are not listed for files.
        rows = reduce(DataFrame.unionByName, [self.spark.read.schema(self.schema).parquet(path) for path in paths])
        return rows if buckets is None else rows.where(F.col("__bucket").isin(buckets))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Every row from its newest part. An aggregate on key and time: a hot key is many groups."""
        return latest_per_key(rows, [*self.keys, "__ts"], ["__batch"])

    def _write(self, rows: DataFrame, part: Part) -> None:
        rows = rows.select(*self.schema.names).hint("rebalance", "__bucket")
        rows.write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.base}/{part.name}")

    def _merge_full_levels(self) -> None:
        level = 0
        while len(full := [p for p in self.parts() if p.level == level]) >= self.fanout:
            self._write(self._newest(self._read(full)), Part(level + 1, full[0].first, full[-1].last))
            level += 1

    def _drop_merged(self) -> None:
        live = set(self.parts())
        for part in self._all_parts():
            if part not in live:
                remove_tree(self.spark, f"{self.base}/{part.name}")

    # --- batches -------------------------------------------------------------------------

    def apply(self, number: int, batch: DataFrame, ts: str, seq: str, removed: Column | None = None) -> None:
        """Takes in a batch; one that the store holds already changes nothing, so a repeated run is harmless.

        Numbers grow. Rows may lie before rows of earlier batches: what they change is replayed.
        """
        self._drop_merged()
        if self.holds(number):
            return
        if any(p.last > number for p in self.parts()):
            raise ValueError(f"batch {number} comes after a later one")
        rows = sized(self._incoming(batch, ts, seq, removed), "feed-batch")
        replayed = self._replayed(self._met(rows, number))
        changed = replayed.where(
            F.col("__was").isNull() | ~F.struct("__seq", "__kind", "__until").eqNullSafe(F.col("__was"))
        )
        self._write(changed.withColumn("__batch", F.lit(number).cast("bigint")), Part(0, number, number))
        self._merge_full_levels()

    def _incoming(self, batch: DataFrame, ts: str, seq: str, removed: Column | None) -> DataFrame:
        gone = F.lit(False) if removed is None else F.coalesce(removed, F.lit(False))
        valid = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in self.keys))
        known = set(batch.columns)
        return batch.where(valid & F.col(ts).isNotNull()).select(
            *self.keys,
            *[F.when(~gone, F.col(c)).alias(c) for c in self.tracked],
            *[(F.col(c) if c in known else F.lit(None)).cast(self.schema[c].dataType).alias(c) for c in self.carried],
            F.col(ts).cast(self.schema["__ts"].dataType).alias("__ts"), F.col(seq).cast("bigint").alias("__seq"), gone.alias("__gone"),
            F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("__bucket"),
        )

    def _met(self, rows: DataFrame, number: int) -> DataFrame:
        """The batch's rows and the stored ones of their keys, these with what they were (``__was``)."""
        was = F.struct("__seq", "__kind", "__until")
        columns = [*self.keys, *self.tracked, *self.carried, "__ts", "__seq", "__gone", "__bucket", "__batch"]
        held = self._read(self.parts(), []).select(*columns, was.alias("__was"))
        come = rows.withColumn("__batch", F.lit(number).cast("bigint"))
        come = come.select(*columns, F.lit(None).cast(held.schema["__was"].dataType).alias("__was"))
        if not self.parts():
            return come
        buckets = [r[0] for r in rows.select("__bucket").distinct().collect()]  # at most as many as the store has
        touched = sized(rows.select(*self.keys).distinct(), "touched-keys")
        held = self._read(self.parts(), buckets).join(touched, self.keys, "left_semi").select(*columns, was.alias("__was"))
        # Stored, because keys are counted before they are replayed.
        return sized(held.unionByName(come), "feed-rows")

    def _replayed(self, rows: DataFrame) -> DataFrame:
        """One row per key and time with its kind and the end of its version, from what stands before and after each.

        One shuffle by key: every window below works on rows that lie together.
        """
        cut = split_hot_keys(rows, self.keys, in_time_chunks(rows, "__ts"), self.hot_rows)
        group = [*self.keys, *[c for c in cut.columns if c == "__chunk"]]
        cut = cut.repartition(*group)
        # Of rows with one number too, the one that compares greatest; of stored copies the newest part's.
        at_once = Window.partitionBy(*group, "__ts").orderBy("__seq", "__gone", *self.tracked, *self.carried, "__batch")
        upto = at_once.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        once = cut.withColumns({"__was": F.last("__was", ignorenulls=True).over(upto), "__more": F.lead(F.lit(True)).over(at_once)})
        once = once.where(F.col("__more").isNull()).drop("__more", "__batch")
        seen = with_neighbours(
            once.withColumn("__state", F.struct("__gone", *self.tracked)), self.keys, ["__ts"], previous={"__state": "__last"}
        )
        turns = F.when(F.col("__last").isNull(), ~F.col("__gone")).otherwise(~F.col("__state").eqNullSafe(F.col("__last")))
        kind = F.when(~turns, SILENT).when(F.col("__gone"), END).otherwise(VERSION)
        seen = seen.withColumn("__kind", kind).drop("__state", "__last").withColumn("__silent", F.col("__kind") == SILENT)
        # Changes follow changes; silent rows, which have no end, are a sequence of their own.
        timed = with_neighbours(seen, [*self.keys, "__silent"], ["__ts"], following={"__ts": "__until"})
        # An end has no end of its own.
        return timed.withColumn("__until", F.when(F.col("__kind") == VERSION, F.col("__until"))).drop("__silent")

    # --- reading -------------------------------------------------------------------------

    def versions(self, validity: Validity = Validity()) -> DataFrame:
        """All versions as of the last batch."""
        rows = self._newest(self._read(self.parts())).where(F.col("__kind") == VERSION)
        return rows.select(
            *self.keys, *self.tracked, *self.carried, F.col("__ts").alias(validity.start),
            F.col("__until").alias(validity.end), F.col("__until").isNull().alias(validity.current),
        )
