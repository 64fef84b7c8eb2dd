"""Change-feed pages, marks, run log and quality checks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rosterline import schemas
from rosterline.operators import increments as L, quality as Q
from rosterline.operators.runlog import RunLog, runs_of_events
from rosterline.sources import pages as P

T = "2025-01-01T00:00:0{}.000000"


def page(batch, seq, value, last=False, error=None, scope="groups"):
    return {"scope": scope, "batch_id": batch, "page_seq": seq, "received_ts": T.format(seq), "error": error, "value": value,
            ("@odata.deltaLink" if last else "@odata.nextLink"): f"{batch}-{seq}"}


@pytest.fixture
def land(spark, tmp_path):
    def write(pages, record=schemas.GROUP_RECORD):
        (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
        return P.read_pages(spark, str(tmp_path), record)

    return write


GROUP = {"id": "g1", "displayName": "One", "securityEnabled": True, "groupTypes": ["Unified"],
         "lastModifiedDateTime": "2025-01-01T00:00:00Z",
         "members@delta": [{"id": "m1"}, {"id": "m2", "@removed": {"reason": "deleted"}}], "owners@delta": [{"id": "o1"}]}
GONE = {"id": "g2", "@removed": {"reason": "deleted"}, "members@delta": [{"id": "m9"}]}


def test_only_finished_batches_count_and_retries_count_once(land):
    pages = land([
        page("b1", 0, [GROUP]), page("b1", 0, [GROUP]), page("b1", 1, [GONE], last=True),
        page("b2", 0, [GROUP]),                                    # no token yet
        page("b3", 0, None, error="503"), page("b3", 0, [GROUP], last=True),  # failed, then landed
        page("b4", 1, [GROUP], last=True),                         # page 0 missing
        page("b5", 0, [GROUP], error="500"), page("b5", 1, [], last=True),
    ])
    status = {r.batch_id: (r.pages, r.records, r.delta_link, r.is_complete) for r in P.batch_status(pages).collect()}
    assert status["b1"] == (2, 2, "b1-1", True) and status["b3"] == (1, 1, "b3-0", True)
    assert not any(status[b][3] for b in ("b2", "b4", "b5"))
    records = P.flatten_pages(pages)
    assert {(r.batch_id, r.page_seq, r.position, r.record["id"]) for r in records.collect()} == {
        ("b1", 0, 0, "g1"), ("b1", 1, 0, "g2"), ("b3", 0, 0, "g1")}


def test_group_rows_and_link_changes(land):
    records = P.flatten_pages(land([page("b", 0, [GROUP, GONE, {"displayName": "no id"}], last=True)]))
    groups = {r.group_id: r for r in P.group_rows(records).collect()}
    assert groups["g2"].removed and not groups["g1"].removed and set(groups) == {"g1", "g2"}
    assert groups["g1"].group_types == ["Unified"] and groups["g1"].last_modified == datetime(2025, 1, 1)
    assert json.loads(groups["g1"].raw_json)["displayName"] == "One"
    members = P.link_changes(records, "members@delta", "member_id").select("group_id", "member_id", "action").collect()
    assert {tuple(r) for r in members} == {("g1", "m1", "add"), ("g1", "m2", "remove")}
    assert P.link_changes(records, "owners@delta", "owner_id").count() == 1


def test_principal_kinds(land):
    values = [{"id": "a", "@odata.type": "#microsoft.graph.user"}, {"id": "b", "@odata.type": "#microsoft.graph.group"}, {"id": "c"}]
    records = P.flatten_pages(land([page("b", 0, values, last=True, scope="g7")], schemas.PRINCIPAL_RECORD))
    got = P.principal_rows(records).select("group_id", "principal_id", "principal_type").collect()
    assert {tuple(r) for r in got} == {("g7", "a", "User"), ("g7", "b", "Group"), ("g7", "c", "Other")}


def test_fan_out_flags_keys_that_are_not_whole(spark, land):
    record = "id STRING, displayName STRING, userPrincipalName STRING"
    pages = land([
        page("x", 0, [{"id": "o1"}], scope="g1"), page("x", 1, [{"id": "o2"}], last=True, scope="g1"),
        page("x", 0, [], last=True, scope="g2"), page("x", 0, [{"id": "o3"}], scope="g3"),
        page("x", 0, [{"id": "o9"}], last=True, scope="unasked"),
    ], record).withColumnRenamed("scope", "key")
    keys = spark.createDataFrame([("g1",), ("g2",), ("g3",), ("g4",), ("g1",)], "key STRING")
    got = P.fan_out(keys, pages, "key").select("key", "record.id", "key_complete").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("g1", "o1", True), ("g1", "o2", True), ("g2", None, True), ("g3", "o3", False), ("g4", None, False)], key=str)


def test_token_moves_only_with_a_finished_batch(spark, land):
    pages = land([page("b1", 0, [GROUP], last=True), page("b2", 0, [GROUP], scope="users")])
    tokens = spark.createDataFrame([("users", "old", None, None), ("groups", "old", None, None)], schemas.CHANGE_MARKS)
    moved = L.commit_tokens(tokens, P.batch_status(pages), datetime(2024, 12, 31))
    assert {(r.scope, r.delta_link, r.snapshot_filter_from) for r in moved.collect()} == {
        ("users", "old", None), ("groups", "b1-0", datetime(2024, 12, 31))}


def landed(folder, pages):
    for one in pages:
        where = folder / f"scope={one['scope'].replace('/', '%2F')}" / f"batch_id={one['batch_id']}"
        where.mkdir(parents=True, exist_ok=True)
        body = {k: v for k, v in one.items() if k not in ("scope", "batch_id")}
        (where / f"{one['page_seq']}-{len(list(where.iterdir()))}.json").write_text(json.dumps(body))


def stored_rows(records):
    return P.group_rows(records, keep=("scope", "batch_id", "received_ts"))


def test_rows_are_stored_before_the_mark_and_a_retry_repeats_nothing(spark, tmp_path, monkeypatch):
    landed(tmp_path / "in", [page("b1", 0, [GROUP, GONE], last=True, scope="a/b")])
    args = (spark, str(tmp_path / "in"), schemas.GROUP_RECORD, stored_rows, str(tmp_path / "rows"), str(tmp_path / "marks"))

    def fail(*_):
        raise RuntimeError("disk")

    with monkeypatch.context() as broken:
        broken.setattr(L, "replace_partitions", fail)
        with pytest.raises(RuntimeError):
            L.land_batches(*args)
    assert not (tmp_path / "marks").exists()
    assert L.land_batches(*args) is not None and L.land_batches(*args) is None
    got = spark.read.parquet(args[4])
    assert {(r.group_id, r.scope, r.batch_id) for r in got.collect()} == {("g1", "a/b", "b1"), ("g2", "a/b", "b1")} and got.count() == 2
    assert [(r.scope, r.delta_link, r.batch_id) for r in L.landed_marks(spark, args[5]).collect()] == [("a/b", "b1-0", "b1")]


def test_only_folders_above_the_mark_are_read(spark, tmp_path):
    source = tmp_path / "in"
    args = (spark, str(source), schemas.GROUP_RECORD, stored_rows, str(tmp_path / "rows"), str(tmp_path / "marks"))
    landed(source, [page("b1", 0, [GROUP], last=True), page("b2", 0, [GROUP]), page("b1", 0, [GROUP], last=True, scope="users")])
    assert len(L.land_batches(*args).inputFiles()) == 3
    landed(source, [page("b3", 0, [GONE], last=True), page("b2", 0, [GONE], last=True, scope="users")])
    files = L.land_batches(*args).inputFiles()
    assert sorted("/".join(f.split("/")[-3:-1]) for f in files) == [
        "scope=groups/batch_id=b2", "scope=groups/batch_id=b3", "scope=users/batch_id=b2"]
    assert L.land_batches(*args) is None  # b2 of groups was given up when b3 finished
    assert {(r.scope, r.batch_id) for r in L.landed_marks(spark, args[5]).collect()} == {("groups", "b3"), ("users", "b2")}
    assert {(r.scope, r.batch_id, r.group_id) for r in spark.read.parquet(args[4]).collect()} == {
        ("groups", "b1", "g1"), ("users", "b1", "g1"), ("groups", "b3", "g2"), ("users", "b2", "g2")}


def test_an_unfinished_batch_waits_for_its_last_page(spark, tmp_path):
    source = tmp_path / "in"
    args = (spark, str(source), schemas.GROUP_RECORD, stored_rows, str(tmp_path / "rows"), str(tmp_path / "marks"))
    landed(source, [page("b1", 0, [GROUP])])
    L.land_batches(*args)
    assert L.landed_marks(spark, args[5]).isEmpty()
    landed(source, [page("b1", 1, [GONE], last=True)])
    L.land_batches(*args)
    assert spark.read.parquet(args[4]).count() == 2 and L.landed_marks(spark, args[5]).first().batch_id == "b1"


def test_a_failing_step_leaves_its_event(spark, tmp_path):
    ticks = iter(datetime(2025, 1, 1, 0, 0, i) for i in range(60))
    log = RunLog(spark, str(tmp_path / "log"), lambda: next(ticks))
    with log.step("r1", "S", "e") as step:
        step.stores(spark.range(5), lambda df: df.write.parquet(str(tmp_path / "a")))
        step.stores(spark.range(2), lambda df: df.write.parquet(str(tmp_path / "b")))
        step.pages(spark.createDataFrame([("s", "b1", 0, 5), ("s", "b1", 1, 2)], "scope STRING, batch_id STRING, page_seq BIGINT, records BIGINT"))
    with pytest.raises(ValueError, match="broken"):
        with log.step("r2", "S", "e") as step:
            step.stores(spark.range(3), lambda df: df.write.parquet(str(tmp_path / "c")))
            raise ValueError("broken")
    with pytest.raises(Exception):
        with log.step("r3", "S", "e") as step:
            step.stores(spark.range(3), lambda df: df.select(F.raise_error(F.lit("bad row"))).write.parquet(str(tmp_path / "d")))
    events = [(r.run_id, r.event, r.page_seq, r.records) for r in log.events().orderBy("at", "page_seq").collect()]
    assert events == [("r1", "START", None, None), ("r1", "PAGE", 0, 5), ("r1", "PAGE", 1, 2), ("r1", "SUCCESS", None, 7),
                      ("r2", "START", None, None), ("r2", "FAIL", None, 3), ("r3", "START", None, None), ("r3", "FAIL", None, 0)]
    runs = {r.run_id: r for r in runs_of_events(log.events()).collect()}
    assert runs["r1"].status == "SUCCESS" and runs["r1"].rows_ingested == 7 and runs["r2"].notes == "ValueError: broken"
    assert "bad row" in runs["r3"].notes and runs["r1"].started_at < runs["r1"].ended_at
    assert tuple(Q.run_summary(runs_of_events(log.events())).first())[:5] == ("S", "e", 3, 2, 7)


def test_increments_cover_the_feed_once(spark):
    feed = spark.range(100).select((F.col("id") % 3).alias("scope"), F.col("id").alias("seq"))
    marks, taken = spark.createDataFrame([], "scope BIGINT, mark BIGINT"), []
    for limit in (30, 30, 77, 100):
        step = L.above_mark(feed.where(F.col("seq") < limit), marks, "scope", "seq")
        taken += [r.seq for r in step.collect()]
        marks = spark.createDataFrame(L.next_marks(marks, step, "scope", "seq").collect(), "scope BIGINT, mark BIGINT")
    assert sorted(taken) == list(range(100))


def test_latest_batch_goes_by_time_not_by_name(spark):
    feed = spark.createDataFrame(
        [("g1", "seed_20250101", datetime(2025, 1, 1)), ("g2", "incr_20260101", datetime(2026, 1, 1))],
        "id STRING, delta_batch_id STRING, received_ts TIMESTAMP_NTZ")
    assert [r.id for r in L.latest_batch_keys(feed, "id").collect()] == ["g2"]
    assert L.latest_batch_keys(feed.where("id = 'none'"), "id").count() == 0


def test_null_keys_fail_the_run_with_all_names(spark):
    users = spark.createDataFrame([("u",), (None,)], "user_object_id STRING")
    report = Q.null_keys({"dim_user": (users, ["user_object_id"]), "clean": (users.dropna(), ["user_object_id"])})
    assert {tuple(r) for r in report.collect()} == {("Null user_object_id in dim_user", 1), ("Null user_object_id in clean", 0)}
    with pytest.raises(Q.QualityError, match="Null user_object_id in dim_user"):
        Q.require(report)
    Q.require(report.where("violations = 0"))


def test_history_violations_are_found(spark):
    d = [datetime(2025, 1, i) for i in range(1, 6)]
    rows = [("ok", d[0], d[1], False), ("ok", d[1], None, True), ("over", d[0], d[3], False), ("over", d[2], None, True),
            ("back", d[2], d[2], False), ("two", d[0], None, True), ("two", d[1], None, True), ("end", d[0], d[1], True)]
    df = spark.createDataFrame(rows, "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN")
    expected = {"ends before it starts": 1, "overlaps an earlier version": 2, "current with an end": 1, "more than one current": 1}
    assert {r.rule: r.violations for r in Q.validity_violations(df, ["k"]).collect()} == expected
    assert {r.rule: r.violations for r in Q.validity_violations(df, ["k"], hot_rows=1).collect()} == expected
    zoned = df.withColumn("valid_from", F.col("valid_from").cast("timestamp")).withColumn("valid_to", F.col("valid_to").cast("timestamp"))
    assert {r.rule: r.violations for r in Q.validity_violations(zoned, ["k"]).collect()} == expected


def test_a_long_version_overlaps_all_that_begin_inside_it(spark):
    d = lambda n: datetime(2025, 1, n)
    rows = [("k", d(1), d(20), False), ("k", d(2), d(3), False), ("k", d(4), d(5), False), ("k", d(6), None, True),
            ("open", d(1), None, False), ("open", d(2), d(3), False), ("open", d(9), None, True), ("fine", d(1), d(2), False), ("fine", d(2), None, True)]
    df = spark.createDataFrame(rows, "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN")
    for hot_rows in (1, 2, 100):
        found = {r.rule: r.violations for r in Q.validity_violations(df, ["k"], hot_rows=hot_rows).collect()}
        assert found["overlaps an earlier version"] == 5


def test_run_log_without_notes(spark):
    t = datetime(2025, 1, 1)
    runs = Q.run_record(spark, "r1", "S", "e", "SUCCESS", t, t, 5).unionByName(
        Q.run_record(spark, "r2", "S", "e", "FAILED", t, t, 7, "boom"))
    assert tuple(Q.run_summary(runs).first()) == ("S", "e", 2, 1, 5, t)


def test_a_refresh_reads_only_the_changed_buckets(spark, tmp_path):
    children = spark.range(2000).select((F.col("id") % 400).alias("parent"), F.col("id").alias("child"))
    held = L.BucketedChildren(spark, str(tmp_path / "c"), "parent BIGINT, child BIGINT", "parent", buckets=16)
    held.store(children)
    changed = spark.createDataFrame([(7,), (7,), (None,), (399,), (5000,)], "parent BIGINT")
    got = held.of(changed)
    assert {tuple(r) for r in got.collect()} == {(p, p + 400 * i) for p in (7, 399) for i in range(5)} and got.columns == ["parent", "child"]
    keys = spark.createDataFrame([(7,), (399,), (5000,)], "parent BIGINT")
    wanted = {r[0] for r in keys.select(F.pmod(F.xxhash64("parent"), F.lit(16))).collect()}
    scanned = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "__bucket" in line and "PartitionFilters" in line]
    assert scanned and all(f"{b}" in scanned[0] for b in wanted)
    held.store(spark.createDataFrame([(7, -1)], "parent BIGINT, child BIGINT").unionByName(children.where("parent <> 7")))
    assert [tuple(r) for r in held.of(changed.where("parent = 7")).collect()] == [(7, -1)]
    assert held.of(changed.where("parent IS NULL")).count() == 0
