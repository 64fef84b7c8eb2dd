"""The stored history of a feed: any order of arrival gives what one replay of all rows gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterline.operators.history import scd2_from_feed
from rosterline.sinks import tables as S
from rosterline.streaming.feed_store import FeedStore, Part
from rosterline.streaming.jobs import follow_feed

ROWS = "g STRING, m STRING, state STRING, note STRING, gone BOOLEAN, seq BIGINT, ts TIMESTAMP_NTZ"


def at(second):
    return datetime(2025, 1, 1) + timedelta(seconds=second)


def frame(spark, rows):
    return spark.createDataFrame([(*r, at(r[5] // 2)) for r in rows], ROWS)


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def replay(spark, rows):
    return as_set(scd2_from_feed(frame(spark, rows), ["g", "m"], ["state"], "ts", ["ts", "seq"], F.col("gone"), carried=("note",)))


def store_at(spark, path, **options):
    return FeedStore(spark, str(path), "g STRING, m STRING", "state STRING", "note STRING", **options)


def feed(seed, n, keys):
    rng = random.Random(seed)
    rows = []
    for seq in rng.sample(range(3 * n), n):
        gone = rng.random() < 0.25
        rows.append((rng.choice("ab"), rng.choice(keys), None if gone else rng.choice("xyz"), f"n{seq}", gone, seq))
    return rows


@pytest.mark.parametrize("seed, fanout, hot", [(1, 2, 1_000_000), (2, 3, 4), (3, 10, 1_000_000)])
def test_shuffled_batches_equal_one_replay(spark, tmp_path, seed, fanout, hot):
    rows = feed(seed, 60, "pqr") + [(None, "p", "x", "n", False, 7), ("a", None, "x", "n", False, 8)]
    store = store_at(spark, tmp_path / "s", fanout=fanout, hot_rows=hot, buckets=3)
    random.Random(seed).shuffle(rows)
    for number in range(5):
        store.apply(number, frame(spark, rows[number::5]), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == replay(spark, rows)


def test_late_rows_give_silent_rows_a_meaning(spark, tmp_path):
    """A repeated state changes nothing until a removal arrives from before it."""
    first = [("a", "p", "x", "n2", False, 2), ("a", "p", "x", "n10", False, 10), ("a", "q", None, "n4", True, 4)]
    late = [("a", "p", None, "n6", True, 6), ("a", "q", "y", "n2", False, 2)]
    store = store_at(spark, tmp_path / "s")
    store.apply(0, frame(spark, first), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == {("a", "p", "x", "n2", at(1), None, True)}
    store.apply(1, frame(spark, late), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == {
        ("a", "p", "x", "n2", at(1), at(3), False), ("a", "p", "x", "n10", at(5), None, True), ("a", "q", "y", "n2", at(1), at(2), False)
    } == replay(spark, first + late)


def test_rows_of_one_time_from_several_batches(spark, tmp_path):
    rows = [[("a", "p", "x", "n", False, 4)], [("a", "p", "y", "n", False, 5)], [("a", "p", "x", "n", False, 4), ("a", "p", "z", "n", False, 2)]]
    store = store_at(spark, tmp_path / "s")
    for number, batch in enumerate(rows):
        store.apply(number, frame(spark, batch), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == {("a", "p", "z", "n", at(1), at(2), False), ("a", "p", "y", "n", at(2), None, True)}


def test_a_batch_writes_what_it_touches_and_the_folder_follows_the_data(spark, tmp_path):
    store = store_at(spark, tmp_path / "s", fanout=3, buckets=2)
    many = [("a", f"k{i}", "x", "n", False, i) for i in range(3000)]
    store.apply(0, frame(spark, many), "ts", "seq", F.col("gone"))
    everything = list(many)
    for number in range(1, 13):
        batch = [("a", f"k{number}", f"s{number % 2}", "n", False, 10_000 + 2 * number), ("a", "k0", f"s{number % 2}", "n", False, 10_001 + 2 * number)]
        everything += batch
        store.apply(number, frame(spark, batch), "ts", "seq", F.col("gone"))
        newest = [p for p in store._all_parts() if p.last == number and p.level == 0]
        if newest:
            assert store._read(newest).count() <= 6  # two new rows, and those whose end they set
    assert as_set(store.versions()) == replay(spark, everything)
    store._drop_merged()
    held = sum(spark.read.parquet(str(f)).count() for f in (tmp_path / "s").iterdir())
    assert held <= len(everything) + 60 and len(list((tmp_path / "s").iterdir())) <= 2 * 3


def test_batches_twice_and_out_of_turn(spark, tmp_path):
    store = store_at(spark, tmp_path / "s", fanout=2)
    rows = [("a", "p", "x", "n", False, 2)]
    for number in (0, 1, 1, 0):
        store.apply(number, frame(spark, rows), "ts", "seq", F.col("gone"))
    assert store.parts() == [Part(1, 0, 1)] and store.holds(0) and not store.holds(2)
    store.apply(5, frame(spark, rows[:0]), "ts", "seq", F.col("gone"))
    with pytest.raises(ValueError, match="after a later one"):
        store.apply(3, frame(spark, rows), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == {("a", "p", "x", "n", at(1), None, True)}


def test_an_unfinished_part_does_not_count(spark, tmp_path):
    store = store_at(spark, tmp_path / "s")
    assert store.versions().isEmpty() and store.parts() == []
    store.apply(0, frame(spark, [("a", "p", "x", "n", False, 2)]), "ts", "seq", F.col("gone"))
    broken = tmp_path / "s" / "part-1-0-9"
    broken.mkdir()
    assert store.versions().count() == 1 and store.parts() == [Part(0, 0, 0)]


def test_followed_feed(spark, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "p")
    store = store_at(spark, tmp_path / "s")
    rows = feed(9, 30, "pq")
    for part in (rows[::2], rows[1::2], []):
        if part:
            S.append(frame(spark, part), source)
        follow_feed(spark, source, frame(spark, rows).schema, store, progress, "ts", "seq", F.col("gone"))
        assert as_set(store.versions()) == replay(spark, rows[::2] if part == rows[::2] else rows)


def test_a_replay_shuffles_its_rows_once(spark, tmp_path):
    store = store_at(spark, tmp_path / "s")
    rows = feed(4, 40, "pq")
    store.apply(0, frame(spark, rows[::2]), "ts", "seq", F.col("gone"))
    plan = store._replayed(store._met(store._incoming(frame(spark, rows[1::2]), "ts", "seq", F.col("gone")), 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Aggregate" not in text
    store.apply(1, frame(spark, rows[1::2]), "ts", "seq", F.col("gone"))
    assert as_set(store.versions()) == replay(spark, rows)
