"""Operators over keys that stay correct and parallel when one key owns much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from rosterline.workspace import sized, stored

HOT_ROWS = 1_000_000


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a
    hot key costs no more than any other. ``order`` must be unique per key.
    """
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.distinct()
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__row"))
    return newest.select(*keys, *[F.col("__row").getField(c).alias(c) for c in values]).select(*df.columns)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, NULL keys included: of several the one whose other columns compare greatest."""
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.distinct()
    greatest = df.groupBy(*keys).agg(F.max(F.struct(*values)).alias("__row"))
    return greatest.select(*keys, *[F.col("__row").getField(c).alias(c) for c in values]).select(*df.columns)


def top_by_distinct(df: DataFrame, key: str, counted: str, k: int, count_name: str = "events") -> DataFrame:
    """The ``k`` keys with most distinct ``counted`` values; equal counts go by key order."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.countDistinct(counted).alias(count_name))
        .orderBy(F.desc(count_name), F.asc(key))
        .limit(k)
    )


def in_chunks(seq: str, rows: int = HOT_ROWS) -> Column:
    """A chunk number for an integral ``seq`` that is unique per key.

    A chunk spans ``rows`` numbers, so no (key, chunk) group holds more than ``rows`` rows
    however hot the key is.
    """
    return F.floor(F.col(seq) / F.lit(rows)).cast("bigint")


def in_time_chunks(df: DataFrame, ts: str, minutes: int = 1) -> Column:
    """A chunk number for rows ordered by time: the number of their span of ``minutes``."""
    if df.schema[ts].dataType.simpleString() == "timestamp":
        total = F.floor(F.unix_seconds(ts) / 60)
    else:
        total = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return F.floor(total / minutes).cast("bigint")


def split_hot_keys(df: DataFrame, keys: list[str], chunk: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``__chunk``: the chunk number for keys with more than ``hot_rows`` rows, else NULL.

    Rows are counted per key first, with partial counts before the shuffle. At most one key
    in ``hot_rows`` rows can be hot, so their list is small; it is stored, and if it is
    empty, as with most tables, the column is left out. Rows without a chunk number come first.
    """
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_rows).select(*keys)
    hot, found = stored(hot, "hot-keys", F.count(F.lit(1)))
    if not found:
        return df
    flagged = df.withColumn("__number", F.coalesce(chunk, F.lit(-1).cast("bigint")))
    flagged = flagged.join(hot.withColumn("__hot", F.lit(True)), keys, "left")
    # Stored, because every step that looks across chunks reads its input twice.
    return sized(flagged.select(*df.columns, F.when(F.col("__hot"), F.col("__number")).alias("__chunk")), "chunked-rows")


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Adds values of the row before and the row after, per key in ``order``.

    ``previous`` and ``following`` map a source column to the name of the added column. A
    window over a hot key would gather it in one task, so on the result of
    ``split_hot_keys`` the window runs inside (key, chunk), and for hot keys only, each
    chunk is aggregated to its border rows, which are put in order per key and joined back
    on (key, chunk), for which the windowed side is already partitioned. Chunk numbers
    must grow with ``order``; keys must not be NULL.
    """
    split = "__chunk" in df.columns
    group = [*keys, "__chunk"] if split else keys
    inside = Window.partitionBy(*group).orderBy(*order)
    per_key = Window.partitionBy(*keys).orderBy("__chunk")
    borders, across, added, temporary = [], {}, {}, []

    windowed = df
    sides = (("__before", previous or {}, F.lag, F.max_by), ("__after", following or {}, F.lead, F.min_by))
    for name, columns, offset, edge in sides:
        if not columns:
            continue
        payload = F.struct(*columns)
        windowed = windowed.withColumn(name, offset(payload).over(inside))
        neighbour = F.coalesce(name, f"{name}_chunk") if split else F.col(name)
        added.update({new: neighbour.getField(old) for old, new in columns.items()})
        temporary.append(name)
        if split:
            borders.append(edge(payload, F.struct(*order)).alias(f"{name}_edge"))
            across[f"{name}_chunk"] = offset(F.col(f"{name}_edge")).over(per_key)
    if split:
        chunks = df.where(F.col("__chunk").isNotNull()).groupBy(*group).agg(*borders)
        edges = chunks.withColumns(across).select(*group, *across)
        windowed = windowed.join(edges, group, "left")
        temporary += list(across)
    return windowed.withColumns(added).drop(*temporary).select(*df.columns, *added)


def earlier_max(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the greatest ``value`` of all rows before, per key in ``order``; NULL for the first.

    On the result of ``split_hot_keys`` the running maximum goes chunk by chunk, and a prefix scan
    over the chunks' maxima, one row per chunk, carries it across. Chunk numbers must grow with ``order``.
    """
    split = "__chunk" in df.columns
    group = [*keys, "__chunk"] if split else keys
    before = lambda part, *by: Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(name, F.max(value).over(before(group, *order)))
    if not split:
        return rows
    chunks = df.where(F.col("__chunk").isNotNull()).groupBy(*group).agg(F.max(value).alias("__max"))
    carried = chunks.select(*group, F.max("__max").over(before(keys, "__chunk")).alias("__carried"))
    return rows.join(carried, group, "left").withColumn(name, F.greatest(name, "__carried")).drop("__carried")


def carried_forward(df: DataFrame, keys: list[str], order: list[Column], value: Column, latest: Column, name: str) -> DataFrame:
    """Adds the last ``value`` that is not NULL up to and with each row, per key in ``order``.

    Hot keys go chunk by chunk as in :func:`earlier_max`; ``latest`` orders the values of a chunk.
    """
    split = "__chunk" in df.columns
    group = [*keys, "__chunk"] if split else keys
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    if not split:
        return rows
    chunks = df.where(F.col("__chunk").isNotNull()).groupBy(*group).agg(F.max_by(value, F.when(value.isNotNull(), latest)).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*group, F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    return rows.join(carried, group, "left").withColumn(name, F.coalesce(name, "__carried")).drop("__carried")


def numbered(df: DataFrame, keys: list[str], order: str, chunk: Column, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds a number from 0 per key in ``order``; hot keys are counted chunk by chunk."""
    rows = split_hot_keys(df, keys, chunk, hot_rows)
    split = "__chunk" in rows.columns
    group = [*keys, "__chunk"] if split else keys
    inside = (F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1).cast("bigint")
    if not split:
        return rows.withColumn(name, inside)
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.where(F.col("__chunk").isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("__rows"))
        .select(*group, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"))
    )
    return (
        rows.withColumn("__inside", inside).join(offsets, group, "left")
        .withColumn(name, F.col("__inside") + F.coalesce("__offset", F.lit(0))).select(*df.columns, name)
    )


def order_chunks(df: DataFrame, order: str, rows: int = HOT_ROWS) -> Column:
    """A chunk number that grows along ``order``, from its type; other types raise ``ValueError``."""
    kind = df.schema[order].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return in_chunks(order, rows)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return in_time_chunks(df, order)
    raise ValueError(f"rows ordered by {order} ({kind}) need a chunk number of their own")


OUTPUT_ROWS = 10_000


def mapped_rows(
    df: DataFrame, keys: list[str], function, output: str, key_schema: str, partitions: int | None = None
) -> DataFrame:
    """Runs ``function(key values) -> list of rows`` for every distinct key, in Arrow batches.

    The output has the key columns, ``output`` (a DDL list of value columns) and ``error``.
    A key whose call fails gives one row with the error text; its neighbours go on. Only
    for logic no column expression can state. Distinct keys are dealt to ``partitions`` tasks
    (by default ``spark.sql.shuffle.partitions``), which the adaptive planner leaves alone, and
    rows are handed on in pieces, so a task holds the rows of one call and one piece.
    """
    value_names = StructType.fromDDL(output).fieldNames()

    def rows_of_batches(batches):
        import pandas as pd

        columns = [*keys, *value_names, "error"]
        for batch in batches:
            collected = []
            for key in batch[keys].itertuples(index=False, name=None):
                try:
                    collected += [(*key, *row, None) for row in function(*key)]
                except Exception as problem:  # one bad key must not fail the partition
                    collected.append((*key, *[None] * len(value_names), repr(problem)))
                while len(collected) >= OUTPUT_ROWS:
                    yield pd.DataFrame(collected[:OUTPUT_ROWS], columns=columns, dtype=object)
                    del collected[:OUTPUT_ROWS]
            yield pd.DataFrame(collected, columns=columns, dtype=object)

    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct_keys = df.select(*keys).distinct().repartition(tasks, *keys)
    return distinct_keys.mapInPandas(rows_of_batches, f"{key_schema}, {output}, error STRING")
