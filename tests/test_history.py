"""Histories: the adopted semantics on small fixtures, and their invariants."""

from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterline.operators import history as H
from rosterline.operators.quality import validity_violations

T0, T1, T2 = datetime(2025, 1, 1), datetime(2025, 1, 2), datetime(2025, 1, 3)
OWNER = "group_id STRING, owner_id STRING, name STRING"
KEYS = ["group_id", "owner_id"]
S0 = [("g1", "a", "A"), ("g1", "b", "B"), ("g2", "c", None)]
S1 = [("g1", "a", "A2"), ("g2", "c", ""), ("g3", "d", "D")]


def owners(spark, rows):
    return spark.createDataFrame(rows, OWNER)


def apply(spark, history, rows, ts, **options):
    return H.scd2_from_snapshot(history, owners(spark, rows), KEYS, ["name"], ts, **options)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def first(spark):
    return H.bootstrap(owners(spark, S0), T0)


def test_bootstrap_makes_all_current(spark):
    assert as_set(first(spark)) == {(g, o, n, T0, None, True) for g, o, n in S0}


def test_changed_closes_and_reopens_null_differs_from_empty_removed_closes(spark):
    assert as_set(apply(spark, first(spark), S1, T1)) == {
        ("g1", "a", "A", T0, T1, False), ("g1", "a", "A2", T1, None, True),
        ("g1", "b", "B", T0, T1, False),
        ("g2", "c", None, T0, T1, False), ("g2", "c", "", T1, None, True),
        ("g3", "d", "D", T1, None, True),
    }


def test_same_snapshot_twice_changes_nothing(spark):
    once = apply(spark, first(spark), S1, T1)
    assert as_set(apply(spark, once, S1, T1)) == as_set(once)
    assert as_set(apply(spark, once, S1, T2)) == as_set(once)


def test_returning_key_reopens(spark):
    back = apply(spark, apply(spark, first(spark), S1, T1), S0, T2)
    assert ("g1", "b", "B", T2, None, True) in as_set(back)
    assert ("g1", "b", "B", T0, T1, False) in as_set(back)
    assert {r.violations for r in validity_violations(back, KEYS).collect()} == {0}


def test_incomplete_source_closes_nothing(spark):
    complete = spark.createDataFrame([("g2",), ("g3",)], "group_id STRING")
    after = as_set(apply(spark, first(spark), [("g3", "d", "D")], T1, complete=complete))
    assert ("g1", "a", "A", T0, None, True) in after and ("g1", "b", "B", T0, None, True) in after
    assert ("g2", "c", None, T0, T1, False) in after


def test_changes_only_input_closes_nothing(spark):
    after = as_set(apply(spark, first(spark), [("g1", "a", "Z")], T1, closes_missing=False))
    assert ("g1", "b", "B", T0, None, True) in after and ("g1", "a", "Z", T1, None, True) in after


def test_duplicate_snapshot_rows_give_one_version(spark):
    after = apply(spark, first(spark), S0 + S0, T1)
    assert as_set(after) == as_set(first(spark)) and after.count() == 3


def test_same_run_replaces_instead_of_closing_with_zero_length(spark):
    after = as_set(apply(spark, first(spark), [("g1", "a", "Z")], T0))
    assert after == {("g1", "a", "Z", T0, None, True)}


def test_earlier_run_cannot_close_a_later_version(spark):
    later = apply(spark, first(spark), S1, T1)
    with pytest.raises(Exception, match="run_ts lies before"):
        apply(spark, later, [("g9", "z", "Z")], datetime(2024, 12, 1)).collect()


def test_own_validity_names(spark):
    start = H.bootstrap(owners(spark, S0), T0, H.OWNER_VALIDITY)
    after = H.scd2_from_snapshot(start, owners(spark, S1), KEYS, ["name"], T1, validity=H.OWNER_VALIDITY)
    assert after.columns[-3:] == ["start_date", "end_date", "is_current"]
    assert after.where("end_date IS NULL").count() == after.where("is_current").count() == 3


FEED = "u STRING, v STRING, removed BOOLEAN, seq BIGINT"


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED).withColumn("ts", F.timestamp_seconds(F.col("seq") * 10).cast("timestamp_ntz"))


def at(second):
    return datetime(1970, 1, 1, 0, 0, second)


def test_feed_drops_no_change_and_closes_on_tombstone(spark):
    rows = [("u1", "x", None, 1), ("u1", "x", None, 2), ("u1", "y", False, 3), ("u1", "y", True, 4),
            ("u2", "z", None, 1), ("u3", None, True, 1), (None, "q", None, 1)]
    got = H.scd2_from_feed(feed(spark, rows), ["u"], ["v"], "ts", "seq", F.col("removed"))
    assert as_set(got) == {
        ("u1", "x", at(10), at(30), False), ("u1", "y", at(30), at(40), False), ("u2", "z", at(10), None, True)
    }


def test_rows_sharing_a_time_count_as_the_last(spark):
    rows = spark.createDataFrame(
        [("k", "a", 1, T0), ("k", "b", 2, T1), ("k", "a", 3, T1), ("k", "c", 4, T2)], "k STRING, v STRING, seq BIGINT, ts TIMESTAMP_NTZ"
    )
    for hot_rows in (1, 100):
        got = H.scd2_from_feed(rows, ["k"], ["v"], "ts", "seq", hot_rows=hot_rows)
        assert as_set(got) == {("k", "a", T0, T2, False), ("k", "c", T2, None, True)}


def test_actions_ignore_orphan_removes(spark):
    rows = [("g", "m", a, i) for i, a in enumerate(["remove", "add", "add", "remove", "remove", "add"])]
    df = spark.createDataFrame(rows, "g STRING, m STRING, action STRING, seq BIGINT").withColumn(
        "ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    got = H.bridge_from_actions(df, ["g", "m"], "action", "ts", "seq")
    assert as_set(got) == {("g", "m", at(1), at(3), False), ("g", "m", at(5), None, True)}


def replay(rows):
    """Brute force: versions of each key by walking its rows in order."""
    out = set()
    for key in {r[0] for r in rows}:
        state, start = None, None
        for _, value, removed, seq in sorted((r for r in rows if r[0] == key), key=lambda r: r[3]):
            now = None if removed else (value,)
            if now != state:
                if state is not None:
                    out.add((key, state[0], at(start), at(seq), False))
                state, start = now, seq
        if state is not None:
            out.add((key, state[0], at(start), None, True))
    return out


EVENTS = st.lists(
    st.tuples(st.sampled_from("pq"), st.sampled_from(["x", "y", None]), st.booleans(), st.integers(0, 59)),
    min_size=1, max_size=30, unique_by=lambda r: (r[0], r[3]),
)


@settings(max_examples=6, deadline=None)
@given(EVENTS, st.integers(0, 59))
def test_replay_matches_brute_force_in_any_number_of_batches(spark, rows, cut):
    df = spark.createDataFrame(rows, FEED).withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    whole = H.scd2_from_feed(df, ["u"], ["v"], "ts", "seq", F.col("removed"), hot_rows=5)
    assert as_set(whole) == replay(rows)
    early = H.scd2_from_feed(df.where(F.col("seq") < cut), ["u"], ["v"], "ts", "seq", F.col("removed"))
    late = df.where(F.col("seq") >= cut)
    assert as_set(H.apply_feed(early, late, ["u"], ["v"], "ts", "seq", "removed")) == replay(rows)


def test_insert_if_no_current_never_closes(spark):
    closed = first(spark).where("owner_id <> 'a'").unionByName(
        first(spark).where("owner_id = 'a'").withColumn("is_current", F.lit(False)).withColumn("valid_to", F.lit(T1).cast("timestamp_ntz")))
    after = as_set(H.insert_if_no_current(closed, owners(spark, [("g1", "a", "A"), ("g1", "a", "A")]), KEYS, T2))
    assert ("g1", "a", "A", T2, None, True) in after and ("g1", "b", "B", T0, None, True) in after and len(after) == 4


def test_snapshot_diff_kinds(spark):
    got = as_set(H.snapshot_diff(owners(spark, S0), owners(spark, S1), KEYS, ["name"]))
    assert got == {("g1", "a", "changed"), ("g1", "b", "removed"), ("g2", "c", "changed"), ("g3", "d", "new")}


def test_as_of_takes_start_inclusive_end_exclusive(spark):
    after = apply(spark, first(spark), S1, T1)
    assert as_set(H.as_of(after, T0).select("owner_id", "name")) == {("a", "A"), ("b", "B"), ("c", None)}
    assert as_set(H.as_of(after, T1).select("owner_id", "name")) == {("a", "A2"), ("c", ""), ("d", "D")}


def test_key_history_newest_first(spark):
    after = apply(spark, first(spark), S1, T1)
    assert [r.name for r in H.key_history(after, {"group_id": "g1", "owner_id": "a"}).collect()] == ["A2", "A"]


def test_upsert_keeps_other_keys(spark):
    state = spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, v INT")
    updates = spark.createDataFrame([("b", 2), ("b", 3), ("c", 9)], "k STRING, v INT")
    assert as_set(H.upsert_state(state, updates, ["k"], ["v"])) == {("a", 1), ("b", 3), ("c", 9)}


def test_version_counts(spark):
    assert tuple(H.version_counts(apply(spark, first(spark), S1, T1)).first()) == (6, 3, 3)


CHANGES = "k STRING, v STRING, ts TIMESTAMP_NTZ, pos BIGINT, gone BOOLEAN"


def day(n):
    return datetime(2025, 1, n)


def test_replay_does_not_depend_on_what_counts_as_hot(spark):
    rows = [("h", str(i // 3), day(1 + i // 2), i, i % 11 == 10) for i in range(40)] + [("c", "x", day(3), 0, False), (None, "y", day(3), 0, False)]
    feed = spark.createDataFrame(rows, CHANGES)
    results = [
        as_set(H.scd2_from_feed(feed, ["k"], ["v"], "ts", ["ts", "pos"], F.col("gone"), hot_rows=hot)) for hot in (3, 1_000_000)
    ]
    assert results[0] == results[1] and len(results[0]) > 5


def test_late_rows_fail(spark):
    history = H.bootstrap(spark.createDataFrame([("k", "a")], "k STRING, v STRING"), day(10))
    late = spark.createDataFrame([("k", "b", day(5), 0, False)], CHANGES)
    with pytest.raises(Exception, match="lies before the start"):
        H.apply_feed(history, late, ["k"], ["v"], "ts", "pos", "gone").collect()
    action = late.select("k", "ts", "pos", F.lit("remove").alias("action"))
    with pytest.raises(Exception, match="lies before the start"):
        H.apply_actions(history, action, ["k"], "action", "ts", "pos").collect()


def test_batches_keep_all_columns(spark):
    start = H.bootstrap(spark.createDataFrame([("k", "a", "dept"), ("u", "z", "other")], "k STRING, v STRING, department STRING"), day(1))
    batch = spark.createDataFrame([("k", "b", day(5), 0, False)], CHANGES)
    after = H.apply_feed(start, batch, ["k"], ["v"], "ts", "pos", "gone")
    assert after.columns == start.columns
    assert as_set(after) == {
        ("k", "a", "dept", day(1), day(5), False), ("k", "b", None, day(5), None, True), ("u", "z", "other", day(1), None, True)
    }


def test_state_never_goes_back(spark):
    state = spark.createDataFrame([("a", 9), ("b", 1)], "k STRING, n INT")
    updates = spark.createDataFrame([("a", 3), ("b", 2), ("c", 0)], "k STRING, n INT")
    assert as_set(H.upsert_state(state, updates, ["k"], ["n"])) == {("a", 9), ("b", 2), ("c", 0)}


def test_null_keys_are_keys(spark):
    start = H.bootstrap(spark.createDataFrame([(None, "o", "a"), ("g", None, "b")], "g STRING, o STRING, s STRING"), T0)
    same = start.select("g", "o", "s")
    again = H.scd2_from_snapshot(start, same, ["g", "o"], ["s"], T1)
    assert as_set(again) == as_set(start)
    assert {r.change for r in H.snapshot_diff(same, same, ["g", "o"], ["s"]).collect()} == {"same"}
    assert as_set(H.insert_if_no_current(start, same, ["g", "o"], T1)) == as_set(start)
    gone = H.scd2_from_snapshot(start, same.where("g IS NULL"), ["g", "o"], ["s"], T1)
    assert {(r.g, r.is_current) for r in gone.collect()} == {(None, True), ("g", False)}


def test_as_of_join_meets_one_version(spark):
    history = spark.createDataFrame(
        [("k", "a", day(2), day(5)), ("k", "b", day(5), day(7)), ("k", "c", day(9), None), ("l", "z", day(1), None), (None, "n", day(1), None)],
        "k STRING, v STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    asked = [("k", n, day(n)) for n in range(1, 12)] + [("k", 5, day(5)), ("l", 1, day(3)), ("m", 1, day(3)), (None, 1, day(3)), ("k", 0, None)]
    probes = spark.createDataFrame(asked, "k STRING, n INT, at TIMESTAMP_NTZ")
    want = sorted([(k, n, at, next((v for hk, v, s, e in history.collect() if k and hk == k and at and s <= at and (e is None or at < e)), None))
                   for k, n, at in asked], key=str)
    for hot_rows in (1, 3, 100):
        got = H.as_of_join(probes, history, ["k"], "at", ["v"], hot_rows=hot_rows)
        assert got.columns == ["k", "n", "at", "v"] and sorted(map(tuple, got.collect()), key=str) == want


def test_as_of_join_keeps_clashing_names(spark):
    history = spark.createDataFrame([("k", "a", day(2), None)], "k STRING, v STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    probes = spark.createDataFrame([("k", day(3), 1, "x")], "k STRING, at TIMESTAMP_NTZ, valid_to INT, note STRING")
    got = H.as_of_join(probes, history, ["k"], "at", ["v", "valid_from"])
    assert got.columns == ["k", "at", "valid_to", "note", "v", "valid_from"] and tuple(got.first())[4:] == ("a", day(2))
