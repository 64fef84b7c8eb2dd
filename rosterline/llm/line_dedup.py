"""Frequent lines, found with levelled sorted runs of line hashes, and their removal.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower
case; its hash is 64 bits of XXH64. A *run* is a stored table (hash, documents) of files
sorted by hash. Every batch of documents is merge-anti-joined with the hashes already known
to be frequent, and what is left becomes a run of level 0. When a level is full (two runs)
they are merged into one run of the next level, and hashes that reached the limit move to
the frequent runs; with four batches the third and the fourth meet such runs, and there are
three levels. Merges move two numbers per different line, never a text. Runs are not
bucketed tables: Spark 4.1 skips the shuffle of an aggregate over a union of them although
it then reads them unbucketed, so equal hashes do not meet.

Hashes only find frequent keys. The keys themselves are then compared: where lines of one
frequent hash have several keys, each key is counted and dropped by its own text.

Defined cases: NULL and empty texts are one empty line; keys shorter than ``min_chars``
are never dropped; a line that a document repeats counts once for it; repeated rows are
documents of their own; a document that loses all lines keeps the empty text; an empty
table gives an empty table; columns named like an output are replaced, any others stay
whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterline.llm import carried
from rosterline.workspace import fresh_dir, sized, stored

WHITE = " \t\n\x0b\x0c\r"
BATCHES, FANOUT = 4, 2


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched; pure ASCII takes the quick way."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def line_hashes(text: Column, min_chars: int = 1) -> Column:
    """One hash per line in order; NULL for keys of fewer than ``min_chars`` code points."""
    return F.transform(line_keys(text), lambda key: F.when(F.char_length(key) >= min_chars, key_hash(key)))


def line_keys(text: Column) -> Column:
    return F.transform(text_lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(WHITE)))


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


@dataclass
class LineRuns:
    """The state between batches: runs by level, and runs of hashes that reached ``min_docs``."""

    spark: SparkSession
    min_docs: int = 10
    fanout: int = FANOUT
    levels: dict[int, list[str]] = field(default_factory=dict)
    settled: list[str] = field(default_factory=list)

    def _write(self, run: DataFrame) -> str:
        path = fresh_dir(self.spark, "line-run")
        run.sortWithinPartitions("hash").write.parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema("hash BIGINT, documents BIGINT").parquet(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.schema("hash BIGINT, documents BIGINT").parquet(*paths)
        return runs.groupBy("hash").agg(F.sum("documents").alias("documents"))

    def add(self, hashes: DataFrame) -> None:
        """Takes the (distinct per document) line hashes of one batch, column ``hash``."""
        path = self._write(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("documents")))
        if self.settled:
            # Of the stored counts: before the aggregate, where the optimizer would put it, a frequent line is many rows.
            fresh = self._read(path)
            for known in self.settled:
                fresh = fresh.join(self._read(known).hint("merge"), "hash", "left_anti")
            path = self._write(fresh)
        self.levels.setdefault(0, []).append(path)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        full = self.levels.pop(level)
        merged = self._read(self._write(self._merged(full)))
        enough = F.col("documents") >= self.min_docs
        self.settled.append(self._write(merged.where(enough)))
        self.levels.setdefault(level + 1, []).append(self._write(merged.where(~enough)))

    def frequent(self) -> DataFrame:
        """The hashes found in at least ``min_docs`` documents of all batches so far."""
        # A settled hash may have parts of its count in runs of other levels: one merge over all.
        runs = [*self.settled, *(path for paths in self.levels.values() for path in paths)]
        if not runs:
            return self.spark.createDataFrame([], "hash BIGINT")
        return self._merged(runs).where(F.col("documents") >= self.min_docs).select("hash")


def deduplicate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = BATCHES,
) -> DataFrame:
    """``docs`` without lines whose key is in ``min_docs`` documents; adds ``n_lines``, ``n_dropped``."""
    outputs = ["n_lines", "n_dropped"]
    done = _deduplicated(docs, id_col, text_col, min_docs, min_chars, batches)
    named = [_own(c, text_col) for c in docs.columns if c not in outputs]
    return done.select(*named, *[F.col(f"__{c}").alias(c) for c in outputs])


def _own(name: str, text_col: str) -> Column:
    """A column of the documents, from the result of :func:`_deduplicated`."""
    return F.col("__text").alias(name) if name == text_col else F.col("__row").getField(name).alias(name)


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int, batches: int) -> DataFrame:
    """``__row`` (all columns but the text, as one struct), ``__text``, ``__n_lines``, ``__n_dropped``.

    One scan hashes the lines and stores the hashes in ``batches`` parts, which go through
    the runs one after the other. Rows with frequent lines are found by joining hashes, not
    texts; the texts are shuffled once, to meet their line numbers, with the documents on
    the left so that the adaptive planner can split them.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    row_id, row_hash = F.col(id_col).alias("row_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row_hash")
    texts = docs.select(row_id, row_hash, text.alias("text"))
    hashes = sized_by_batch(
        texts.select(
            "row_id", "row_hash", line_hashes(F.col("text"), min_chars).alias("hashes"),
            F.pmod(F.xxhash64("row_id", "row_hash"), F.lit(batches)).cast("int").alias("batch"),
        )
    )
    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        part = hashes.where(F.col("batch") == batch)
        runs.add(part.select(F.explode(F.array_distinct("hashes")).alias("hash")).where("hash IS NOT NULL"))
    frequent = sized(runs.frequent(), "frequent-lines")
    shared = _keys_that_share_hashes(texts, frequent, min_docs, min_chars)

    alone = frequent if shared is None else frequent.join(shared.select("hash"), "hash", "left_anti")
    dropped = (
        hashes.select("row_id", "row_hash", F.posexplode("hashes").alias("line", "hash"))
        .where("hash IS NOT NULL").join(alone, "hash").select("row_id", "row_hash", "line")
    )
    if shared is not None:
        own = shared.where(F.col("documents") >= min_docs).select("hash", F.col("key").alias("frequent_key"))
        dropped = dropped.unionByName(
            _lines(texts, min_chars).join(own, "hash").where("key = frequent_key").select("row_id", "row_hash", "line")
        )
    found = dropped.groupBy("row_id", "row_hash").agg(F.collect_set("line").alias("drops"))
    # Arrays, not texts, cross the join: expressions on them are then not computed per line.
    others = carried.packed([c for c in docs.columns if c != text_col])
    rows = docs.select(
        others.alias("__row"), F.col(id_col).alias("__row_id"), row_hash.alias("__row_hash"),
        text_lines(text).alias("__lines"), text.isNull().alias("__null"),
    )
    same = rows["__row_id"].eqNullSafe(found["row_id"]) & (rows["__row_hash"] == found["row_hash"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("drops"))
    lines = F.when(F.col("drops").isNull(), F.col("__lines")).otherwise(F.transform(kept, lambda i: F.get("__lines", i)))
    return rows.join(found, same, "left").select(
        "__row",
        F.when(~F.col("__null") | F.col("drops").isNotNull(), F.array_join(lines, "\n")).alias("__text"),
        F.size("__lines").cast("bigint").alias("__n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("bigint").alias("__n_dropped"),
    )


def _lines(texts: DataFrame, min_chars: int) -> DataFrame:
    """(row_id, row_hash, line, key, hash) of all lines with a key."""
    lines = texts.select("row_id", "row_hash", F.posexplode(line_keys(F.col("text"))).alias("line", "key"))
    return lines.where(F.char_length("key") >= min_chars).withColumn("hash", key_hash(F.col("key")))


def _keys_that_share_hashes(texts: DataFrame, frequent: DataFrame, min_docs: int, min_chars: int) -> DataFrame | None:
    """(hash, key, documents) of the frequent hashes that stand for several keys; None if there are none, as nearly always.

    The keys of the frequent lines are compared in one more scan, of which a hash sends its
    least and its greatest key.
    """
    lines = _lines(texts, min_chars).select("hash", "key").join(frequent, "hash")
    keys = lines.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("greatest"))
    mixed, found = stored(keys.where("least <> greatest").select("hash"), "shared-hashes", F.count(F.lit(1)))
    if not found:
        return None
    every = texts.select(F.explode(F.array_distinct(line_keys(F.col("text")))).alias("key")).where(F.char_length("key") >= min_chars)
    every = every.withColumn("hash", key_hash(F.col("key"))).join(mixed, "hash")
    return sized(every.groupBy("hash", "key").agg(F.count(F.lit(1)).alias("documents")), "shared-keys")


def sized_by_batch(hashes: DataFrame) -> DataFrame:
    """Stores the line hashes with one folder per batch."""
    path = fresh_dir(hashes.sparkSession, "line-hashes")
    hashes.write.partitionBy("batch").parquet(path)
    return hashes.sparkSession.read.schema(hashes.schema).parquet(path)


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, less the frequent lines; ``n_chars``, if there, follows the text."""
    done = _deduplicated(docs, id_col, text_col, 10, 1, BATCHES)
    named = {c: _own(c, text_col) for c in docs.columns}
    if "n_chars" in named:
        size = F.char_length("__text").cast(docs.schema["n_chars"].dataType)
        named["n_chars"] = F.when(F.col("__n_dropped") > 0, size).otherwise(F.col("__row").getField("n_chars")).alias("n_chars")
    return done.select(*named.values())
