"""Versioned tables: rows with a validity interval and a current flag."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rosterline.operators.keyed import (
    HOT_ROWS, carried_forward, in_time_chunks, latest_per_key, one_per_key, order_chunks, split_hot_keys, with_neighbours,
)
from rosterline.workspace import sized


@dataclass(frozen=True)
class Validity:
    """Names of the validity columns."""

    start: str = "valid_from"
    end: str = "valid_to"
    current: str = "is_current"

    @property
    def columns(self) -> list[str]:
        return [self.start, self.end, self.current]


# The validity columns of the ownership history.
OWNER_VALIDITY = Validity("start_date", "end_date", "is_current")


def _any_differs(columns: list[str], left: str, right: str) -> Column:
    """True when a column differs between the two structs; NULL equals NULL only."""
    tests = (~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns)
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _packed_key(keys: list[str]) -> Column:
    """The key as one struct: in joins a struct with NULL fields equals another such, a NULL column does not."""
    return F.struct(*keys).alias("__key")


def _paired(old: DataFrame, new: DataFrame, keys: list[str], old_cols: list[str], new_cols: list[str]) -> DataFrame:
    """Full outer join on unique keys, each side packed in a struct that is NULL when absent.

    NULL keys meet like any others. The new side is reduced to one row per key first. That
    aggregate and the join share one shuffle, and with unique keys on both sides no key can be hot.
    """
    left = old.select(_packed_key(keys), F.struct(F.lit(True).alias("__present"), *old_cols).alias("old"))
    packed = F.struct(F.lit(True).alias("__present"), *new_cols)
    right = new.select(_packed_key(keys), packed.alias("__new")).groupBy("__key").agg(F.max("__new").alias("new"))
    pairs = left.join(right, "__key", "full_outer")
    return pairs.select(*[F.col("__key").getField(k).alias(k) for k in keys], "old", "new")


def scd2_from_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    keys: list[str],
    tracked: list[str],
    run_ts: datetime,
    complete: DataFrame | None = None,
    closes_missing: bool = True,
    validity: Validity = Validity(),
) -> DataFrame:
    """History after a full snapshot: opens new keys, closes and reopens changed ones,
    closes missing ones and keeps the rest. Applying a snapshot twice changes nothing.

    ``complete`` limits closing of missing keys to the key values it lists (its columns are
    a subset of ``keys``): a source that was read only in part must not end anything.
    ``closes_missing=False`` is for inputs that hold changes only. ``run_ts`` must not lie
    before the start of a version it would end; that fails the job.
    """
    versions, _ = _split_versions(history, validity)
    others = [c for c in history.columns if c not in keys and c not in validity.columns]
    snapshot = snapshot.withColumns({c: F.lit(None).cast(history.schema[c].dataType)
                                     for c in others if c not in snapshot.columns})
    pairs = _paired(versions, snapshot, keys, [*others, *validity.columns], others)
    if not closes_missing:
        may_close = F.lit(False)
    elif complete is None:
        may_close = F.lit(True)
    else:
        scope = complete.columns
        pairs = pairs.join(complete.distinct().withColumn("__complete", F.lit(True)), scope, "left")
        may_close = F.coalesce("__complete", F.lit(False))

    ts_type = history.schema[validity.start].dataType
    run = F.lit(run_ts.isoformat(sep=" ")).cast(ts_type)
    old, new = F.col("old"), F.col("new")
    started = old.getField(validity.start)

    def version(source: Column, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            *[source.getField(c).alias(c) for c in others],
            start.alias(validity.start), end.cast(ts_type).alias(validity.end),
            F.lit(current).alias(validity.current),
        )

    opened = version(new, run, F.lit(None), True)
    kept = version(old, started, F.lit(None), True)
    closed = version(old, started, F.when(started < run, run).otherwise(
        F.raise_error(F.lit("run_ts lies before the start of a current version"))), False)
    # A version that began with this very run is replaced, not closed with zero length.
    began_now = started == run
    result = (
        F.when(old.isNull(), F.array(opened))
        .when(new.isNull(), F.when(~may_close, F.array(kept)).when(began_now, F.slice(F.array(kept), 1, 0))
              .otherwise(F.array(closed)))
        .when(_any_differs(tracked, "old", "new"), F.when(began_now, F.array(opened)).otherwise(F.array(closed, opened)))
        .otherwise(F.array(kept))
    )
    after = pairs.select(*keys, F.inline(result))
    return _split_versions(history, validity)[1].unionByName(after.select(*history.columns))


def _split_versions(history: DataFrame, validity: Validity) -> tuple[DataFrame, DataFrame]:
    current = F.coalesce(validity.current, F.lit(False))
    return history.where(current), history.where(~current)


def bootstrap(snapshot: DataFrame, run_ts: datetime, validity: Validity = Validity(), ts_type: str = "timestamp_ntz") -> DataFrame:
    """The first snapshot as a history in which every row is current."""
    return snapshot.withColumns(
        {
            validity.start: F.lit(run_ts.isoformat(sep=" ")).cast(ts_type),
            validity.end: F.lit(None).cast(ts_type),
            validity.current: F.lit(True),
        }
    )


def scd2_from_feed(
    feed: DataFrame,
    keys: list[str],
    tracked: list[str],
    ts: str,
    seq: str | list[str],
    removed: Column | None = None,
    unique_ts: bool = False,
    chunk: Column | None = None,
    validity: Validity = Validity(),
    carried: tuple[str, ...] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replays an ordered change feed into versions.

    ``seq`` orders the rows of a key, and times do not decrease along it. A row that
    changes nothing is dropped, a tombstone ends the version, a tombstone without a
    version is ignored. Rows of a key that share a time count as one change, the last;
    ``unique_ts=True`` states that there are none. ``carried`` columns are not compared; a
    version has those of the row that opened it. Rows with a NULL key are left out.

    The feed is shuffled and sorted once. Keys with more than ``hot_rows`` rows are cut in
    chunks by the first column of ``seq`` if that is a number or a time; for any other type
    give ``chunk``, a number that grows along ``seq``, or the call fails at once. A row that
    lies before the version it would end fails the job.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    removed = F.lit(False) if removed is None else F.coalesce(removed, F.lit(False))
    valid = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    state = F.struct(
        removed.alias("gone"), *[F.when(~removed, F.col(c)).alias(c) for c in tracked]
    )
    chunk = order_chunks(feed, order[0], hot_rows) if chunk is None else chunk
    rows = split_hot_keys(feed.where(valid), keys, chunk, hot_rows)
    rows = rows.select(
        *keys, *order, F.col(ts).alias("__ts"), state.alias("__state"), *carried,
        *[c for c in rows.columns if c == "__chunk"],
    )
    if not unique_ts:
        rows = with_neighbours(rows, keys, order, following={"__ts": "__next"})
        rows = rows.where(~F.col("__ts").eqNullSafe(F.col("__next"))).drop("__next")
    seen = with_neighbours(rows, keys, order, previous={"__state": "__last"})
    changed = F.when(F.col("__last").isNull(), ~F.col("__state.gone")).otherwise(
        ~F.col("__state").eqNullSafe(F.col("__last"))
    )
    timed = with_neighbours(seen.where(changed).drop("__last"), keys, order, following={"__ts": "__next"})
    return timed.where(~F.col("__state.gone")).select(
        *keys,
        *[F.col(f"__state.{c}").alias(c) for c in tracked],
        *carried,
        F.col("__ts").alias(validity.start),
        F.when(F.col("__next") < F.col("__ts"), F.raise_error(F.lit("a change lies before the start of the version it ends")))
        .otherwise(F.col("__next")).alias(validity.end),
        F.col("__next").isNull().alias(validity.current),
    )


def bridge_from_actions(
    feed: DataFrame, keys: list[str], action: str, ts: str, seq: str | list[str], unique_ts: bool = False,
    chunk: Column | None = None, validity: Validity = Validity(),
) -> DataFrame:
    """Intervals from add and remove actions: a feed without attributes to track."""
    return scd2_from_feed(
        feed, keys, [], ts, seq, F.col(action) == "remove", unique_ts, chunk, validity
    )


def apply_actions(
    current: DataFrame, batch: DataFrame, keys: list[str], action: str, ts: str, seq: str,
    unique_ts: bool = False, validity: Validity = Validity(),
) -> DataFrame:
    """Versions that a batch of actions leaves or makes, given the current versions.

    Only keys named in the batch pass through the replay; their open version enters it as
    an add at its start. Closed versions of earlier batches are not an input: they never
    change. A batch that reaches back before an open version fails the job.
    """
    touched = sized(batch.select(*keys).distinct(), "touched-keys")
    open_rows = current.where(validity.current)
    untouched = open_rows.join(touched, keys, "left_anti")
    entering = open_rows.join(touched, keys, "left_semi").select(
        *keys, F.col(validity.start).alias(ts), F.lit(-1).cast("bigint").alias(seq), F.lit("add").alias(action)
    )
    feed = entering.unionByName(batch.select(*keys, ts, F.col(seq).cast("bigint").alias(seq), action))
    replayed = bridge_from_actions(feed, keys, action, ts, seq, unique_ts, validity=validity)
    return untouched.select(*replayed.columns).unionByName(replayed)


def apply_feed(
    history: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], ts: str, seq: str,
    removed: str | None = None, validity: Validity = Validity(), carried: tuple[str, ...] = (),
) -> DataFrame:
    """Versions after a batch of attribute changes; the batch may hold many rows per key.

    The open version of every touched key is replayed before the batch; a batch row before
    its start fails the job. Other columns of the history are carried: a new version has
    them from the row that opened it, NULL if the batch does not have them. Store the result
    before applying the next batch: plans of many batches in a row grow with each.
    """
    known = {*keys, *tracked, *carried, *validity.columns}
    others = [c for c in history.columns if c not in known]
    batch = batch.withColumns({c: F.lit(None).cast(history.schema[c].dataType) for c in others if c not in batch.columns})
    carried = (*carried, *others)
    touched = sized(batch.select(*keys).distinct(), "touched-keys")
    open_rows, closed = _split_versions(history, validity)
    untouched = open_rows.join(touched, keys, "left_anti")
    flag = F.coalesce(F.col(removed), F.lit(False)) if removed else F.lit(False)
    entering = open_rows.join(touched, keys, "left_semi").select(
        *keys, *tracked, *carried, F.col(validity.start).alias(ts), F.lit(-1).cast("bigint").alias(seq),
        F.lit(False).alias("__removed"),
    )
    feed = entering.unionByName(
        batch.select(*keys, *tracked, *carried, ts, F.col(seq).cast("bigint").alias(seq), flag.alias("__removed"))
    )
    replayed = scd2_from_feed(
        feed, keys, tracked, ts, seq, F.col("__removed"), validity=validity, carried=carried
    )
    columns = history.columns
    replayed = replayed.select(*columns)
    return closed.select(*columns).unionByName(untouched.select(*columns)).unionByName(replayed)


def insert_if_no_current(
    history: DataFrame, snapshot: DataFrame, keys: list[str], run_ts: datetime, validity: Validity = Validity()
) -> DataFrame:
    """Adds a current row for keys that have none. Never closes anything.

    Of several snapshot rows of a key the one that compares greatest is taken. NULL keys count like others.
    """
    held = history.where(validity.current).select(_packed_key(keys))
    ts_type = history.schema[validity.start].dataType.simpleString()
    opened = bootstrap(one_per_key(snapshot, keys), run_ts, validity, ts_type).withColumn("__key", _packed_key(keys))
    added = opened.join(held, "__key", "left_anti").drop("__key")
    return history.unionByName(added, allowMissingColumns=True)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Every key of two snapshots with ``change``: new, removed, changed or same."""
    pairs = _paired(old, new, keys, tracked, tracked)
    change = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "removed")
        .when(_any_differs(tracked, "old", "new"), "changed")
        .otherwise("same")
    )
    return pairs.select(*keys, change.alias("change"))


def as_of(history: DataFrame, at: datetime, validity: Validity = Validity()) -> DataFrame:
    """Versions valid at an instant."""
    instant = F.lit(at.isoformat(sep=" ")).cast(history.schema[validity.start].dataType)
    end = F.col(validity.end)
    return history.where((F.col(validity.start) <= instant) & (end.isNull() | (end > instant)))


def as_of_join(
    probes: DataFrame, history: DataFrame, keys: list[str], at: str, columns: list[str],
    validity: Validity = Validity(), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row of ``probes`` with ``columns`` (which may be validity columns) of the version valid at its own instant ``at``.

    Versions of a key must not overlap; of several that begin at one time the one that ends last counts. A row without a valid
    version, with a NULL key or a NULL instant has NULLs. Versions and probes are put in one
    order by time and the last version is carried forward, so a probe meets one version, never
    all of its key; keys with more than ``hot_rows`` rows are cut in chunks of time.
    """
    start, end = validity.start, validity.end
    kind = history.schema[start].dataType
    never = F.lit("9999-12-31 23:59:59").cast(kind)
    version = F.struct(F.col(start).alias("__start"), F.coalesce(end, never).alias("__end"), F.struct(*columns).alias("__values"))
    packed = F.struct(*probes.columns)
    versions = history.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys], F.col(start).alias("__at"), F.lit(0).alias("__side"), version.alias("__version")
    )
    asked = probes.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys], F.col(at).cast(kind).alias("__at"), F.lit(1).alias("__side"), packed.alias("__probe")
    )
    by = [f"__key_{k}" for k in keys]
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*by, "__at"]))
    rows = versions.unionByName(asked, allowMissingColumns=True).where(whole)
    rows = split_hot_keys(rows, by, in_time_chunks(rows, "__at"), hot_rows)
    # At one time versions stand before probes: a version holds from its very start.
    order = [F.col("__at"), F.col("__side"), F.col("__version.__end")]
    met = carried_forward(rows, by, order, F.col("__version"), F.col("__version"), "__held").where("__side = 1")
    valid = F.col("__held.__end") > F.col("__at")
    found = met.select("__probe", F.when(valid, F.col("__held.__values")).alias("__values"))
    without = asked.where(~whole).select("__probe", F.lit(None).cast(found.schema["__values"].dataType).alias("__values"))
    return found.unionByName(without).select("__probe.*", *[F.col(f"__values.{c}").alias(c) for c in columns])


def key_history(history: DataFrame, key: dict[str, object], validity: Validity = Validity()) -> DataFrame:
    """All versions of one key, newest first."""
    match = reduce(lambda a, b: a & b, (F.col(c) == F.lit(v) for c, v in key.items()))
    return history.where(match).orderBy(F.desc(validity.start))


def upsert_state(state: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keyed state with the newest row of a key among state and updates: it never goes back.

    State and updates are compared by the columns of ``order`` that the state has; at equal
    ones, or without any, the update stands.
    """
    newest = latest_per_key(updates, keys, order).select(*state.columns)
    held = [c for c in order if c in state.columns]
    both = state.withColumn("__new", F.lit(0)).unionByName(newest.withColumn("__new", F.lit(1)))
    return latest_per_key(both, keys, [*held, "__new"]).drop("__new")


def version_counts(history: DataFrame, validity: Validity = Validity()) -> DataFrame:
    """Total, current and closed versions in one pass."""
    current = F.coalesce(validity.current, F.lit(False))
    return history.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(current).alias("current_rows"),
        F.count_if(~current).alias("closed_rows"),
    )
