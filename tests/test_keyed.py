"""Keyed operators against brute force, with chunks small enough to be crossed."""

import random

from hypothesis import given, settings, strategies as st
import pytest
from pyspark.sql import functions as F

from rosterline.operators import keyed

ROWS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=40, unique=True)


def brute_neighbours(rows):
    out = set()
    for key in {k for k, _ in rows}:
        order = sorted(s for k, s in rows if k == key)
        for i, s in enumerate(order):
            out.add((key, s, order[i - 1] if i else None, order[i + 1] if i + 1 < len(order) else None))
    return out


@settings(max_examples=8, deadline=None)
@given(ROWS, st.integers(1, 7))
def test_neighbours_and_numbers_cross_chunks(spark, rows, width):
    df = spark.createDataFrame(rows, "key STRING, seq BIGINT")
    chunk = keyed.in_chunks("seq", width)
    split = keyed.split_hot_keys(df, ["key"], chunk, hot_rows=width)
    seen = keyed.with_neighbours(split, ["key"], ["seq"], {"seq": "prev"}, {"seq": "next"})
    assert {(r.key, r.seq, r.prev, r.next) for r in seen.collect()} == brute_neighbours(rows)

    counted = keyed.numbered(df, ["key"], "seq", chunk, "n", hot_rows=width).collect()
    assert {(r.key, r.seq, r.n) for r in counted} == {
        (k, s, sorted(x for y, x in rows if y == k).index(s)) for k, s in rows
    }


def test_neighbour_values_may_be_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None)], "k STRING, s BIGINT, v STRING")
    for rows in (df, keyed.split_hot_keys(df, ["k"], keyed.in_chunks("s", 1), hot_rows=1)):
        seen = keyed.with_neighbours(rows, ["k"], ["s"], {"v": "pv", "s": "ps"})
        assert [(r.s, r.ps, r.pv) for r in seen.orderBy("s").collect()] == [(1, None, None), (2, 1, None), (3, 2, "x")]


def test_latest_per_key_keeps_nulls_and_breaks_ties(spark):
    rows = [("a", 1, 1, "x"), ("a", 1, 2, None), ("b", 0, 0, "y")]
    df = spark.createDataFrame(rows, "k STRING, t INT, s INT, v STRING")
    assert {tuple(r) for r in keyed.latest_per_key(df, ["k"], ["t", "s"]).collect()} == {("a", 1, 2, None), ("b", 0, 0, "y")}
    assert keyed.latest_per_key(df.select("k"), ["k"], ["k"]).count() == 2


def test_top_prefers_smallest_name_on_ties_and_skips_null(spark):
    rows = [(v, d) for v in ("v3", "v1", "v2") for d in ("p", "q")] + [(None, x) for x in "abcdef"]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "version STRING, device STRING")
    assert [tuple(r) for r in keyed.top_by_distinct(df, "version", "device", 2).collect()] == [("v1", 2), ("v2", 2)]


def test_only_hot_keys_are_cut_and_their_chunks_are_bounded(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("s"))
    df = hot.unionByName(spark.range(40).select(F.lit("cold").alias("k"), F.col("id").alias("s")))
    split = keyed.split_hot_keys(df, ["k"], keyed.in_chunks("s", 500), hot_rows=500)
    assert split.where("k = 'cold'").where("__chunk IS NOT NULL").count() == 0
    assert split.groupBy("k", "__chunk").count().agg(F.max("count")).first()[0] == 500
    seen = keyed.with_neighbours(split, ["k"], ["s"], following={"s": "next"})
    assert seen.where("next IS NULL").count() == 2
    assert seen.where("next = s + 1").count() == 3038
    assert "__chunk" not in keyed.split_hot_keys(df, ["k"], keyed.in_chunks("s")).columns


def test_failing_key_becomes_an_error_row(spark):
    def rows(key):
        if key == "bad":
            raise ValueError("no")
        return [(1,), (None,)] if key == "two" else []

    df = spark.createDataFrame([("bad",), ("two",), ("two",), ("none",)], "k STRING")
    got = {tuple(r) for r in keyed.mapped_rows(df, ["k"], rows, "n BIGINT", "k STRING").collect()}
    assert got == {("bad", None, "ValueError('no')"), ("two", 1, None), ("two", None, None)}


def test_keys_are_dealt_to_several_tasks(spark):
    def task(key):
        from pyspark import TaskContext

        return [(TaskContext.get().partitionId(),)]

    keys = spark.range(2000).select("id")
    assert len({r["task"] for r in keyed.mapped_rows(keys, ["id"], task, "task BIGINT", "id BIGINT", partitions=5).collect()}) == 5
    wide = keyed.mapped_rows(keys.limit(1), ["id"], lambda key: [(n,) for n in range(25_000)], "n BIGINT", "id BIGINT")
    assert wide.count() == 25_000


def test_one_row_per_key_whatever_the_order(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 1), (None, "c", 2), (None, "b", 3)], "k INT, v STRING, w INT")
    for rows in (df, df.orderBy(F.desc("v")), df.repartition(3)):
        assert {tuple(r) for r in keyed.one_per_key(rows, ["k"]).collect()} == {(1, "b", 1), (None, "c", 2)}


def test_order_without_a_chunk_fails_at_once(spark):
    with pytest.raises(ValueError, match="chunk"):
        keyed.order_chunks(spark.createDataFrame([("a",)], "s STRING"), "s")
