"""Issue rules on literal rows."""

import tempfile
from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from rosterline.functions import columns as C, predicates as P
from rosterline.operators import telemetry as T
from rosterline.schemas import TELEMETRY

AS_OF = datetime(2025, 1, 31)
NAMES = [part.split()[0] for part in TELEMETRY.split(", ")]


def rows(spark, *dicts):
    base = {"gpin": "p", "timeStamp": datetime(2025, 1, 30, 12), "connection": "c", "workLocationId": 1}
    return spark.createDataFrame([tuple({**base, **d}.get(n) for n in NAMES) for d in dicts], TELEMETRY)


def issues(df):
    return {(r.gpin, r.issueType, r.metric, r.timePeriod) for r in df.collect()}


def column(spark, values, kind="STRING"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_composite_build(spark):
    values = ["T2', 'B1','x", "B2','y", "T1','z", "B3,rest", "T1,rest", "plain", None]
    got = [r[0] for r in column(spark, values).select(C.build_version(F.col("v"))).collect()]
    assert got == ["B1", "B2", None, "B3", None, "", None]


def test_recency_edges(spark):
    times = [datetime(2025, 1, 30), datetime(2025, 1, 29, 23), datetime(2025, 1, 28), datetime(2025, 1, 24), datetime(2025, 1, 2)]
    df = column(spark, times, "TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(C.recency_label(F.col("v"), AS_OF)).collect()] == [
        "Last 24 hours", "Last 3 days", "Last 3 days", "Last 7 days", "Last 30 days"]


def test_speaker_rules(spark):
    df = column(spark, ["", None, "My Jabra 75", "Desk unit"])
    assert [r[0] for r in df.where(T.speaker_condition(F.col("v"), 1)).collect()] == ["My Jabra 75", "Desk unit"]
    assert [r[0] for r in df.where(T.speaker_condition(F.col("v"), 2)).collect()] == ["Desk unit"]


def test_null_version_is_no_issue_and_null_in_list_is_ignored(spark):
    listed = column(spark, ["ok", None])
    flagged = T.flag_listed(column(spark, ["ok", "old", None]), F.col("v"), listed, "v", "fine")
    assert {tuple(r) for r in flagged.collect()} == {("ok", True), ("old", False), (None, None)}


def test_fence_and_percentile(spark):
    df = spark.createDataFrame([(1, "c", float(v)) for v in range(1, 9)], "workLocationId BIGINT, connection STRING, latencyAverage DOUBLE")
    assert T.percentile_limits(df).first().latencyThreshold == 6.0
    assert tuple(T.fence_limits(df).first())[2:] == (2.0, 6.0, 12.0)


def test_limits_are_exact_on_a_hot_group(spark):
    n = 2_000_000
    value = ((F.col("id") * 1_299_709) % n).cast("double") / 7
    hot = spark.range(n).select(F.lit(1).cast("bigint").alias("workLocationId"), F.lit("c").alias("connection"), value.alias("latencyAverage"))
    odd = [(2, "c", None), (None, "c", 5.0), (None, "c", None), (3, None, 1.0), (3, None, 2.0), *[(4, "d", float(v // 3)) for v in range(100)]]
    rows = hot.unionByName(spark.createDataFrame(odd, "workLocationId BIGINT, connection STRING, latencyAverage DOUBLE")).repartition(8)
    folder = tempfile.mkdtemp(prefix="run-")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    quartiles = ", ".join(f"quantile_disc(\"latencyAverage\", {share})" for share in (0.25, 0.75, 0.9))
    want = duckdb.sql(f"SELECT \"workLocationId\", connection, {quartiles} FROM '{folder}/rows/*.parquet' GROUP BY 1, 2").fetchall()
    fences = {tuple(r)[:2]: (r.q1, r.q3) for r in T.fence_limits(rows).collect()}
    p75 = {tuple(r)[:2]: r.latencyThreshold for r in T.percentile_limits(rows).collect()}
    p90 = {tuple(r)[:2]: r.latencyThreshold for r in T.percentile_limits(rows, share=0.9).collect()}
    assert fences == {r[:2]: r[2:4] for r in want}
    assert p75 == {r[:2]: r[3] for r in want} and p90 == {r[:2]: r[4] for r in want}


def test_population(spark):
    people = spark.createDataFrame([(i, i, 1 if i < 4 else 2) for i in range(6)], "gpin INT, HriEmployeeId INT, workLocationId INT")
    staff = spark.createDataFrame([(0, 1, "Active"), (1, 2, "Active"), (2, 1, "Left"), (3, 1, "Active"), (4, 1, "Active")], "Id INT, OrganizationalUnitId INT, Status STRING")
    units = spark.createDataFrame([(1, "Wealth", "North"), (2, "Other", "North")], "Id INT, Division STRING, Country STRING")
    places = spark.createDataFrame([(1, "Main Office"), (2, "A Home Worker site")], "Id INT, locationName STRING")
    got = T.eligible_people(people, staff, units, places, "Active", "Wealth", "North", ["%Home Worker%", "%No Workplace%"])
    assert {r.gpin for r in got.collect()} == {0, 3}


def test_report_v1_takes_the_newest_row_and_all_time_limits(spark):
    telemetry = rows(
        spark,
        {"latencyAverage": 9.0, "teamSpeaker": "Jabra", "monitorLayoutCount": 4, "monitorLayoutWidth": 10, "monitorLayoutHeight": 20,
         "thisClientBuildVersion": "b9", "citrixClientVersion": "1.0"},
        {"timeStamp": datetime(2025, 1, 29), "latencyAverage": 99.0, "teamSpeaker": "old"},
        {"timeStamp": datetime(2024, 6, 1), "latencyAverage": 1.0}, {"timeStamp": datetime(2024, 6, 2), "latencyAverage": 2.0},
        {"gpin": "stranger", "latencyAverage": 500.0})
    people = spark.createDataFrame([("p",)], "gpin STRING")
    clients = spark.createDataFrame([(b, d) for b in ("b1", "b2") for d in "xy"] + [("b9", "x")], "BuildVersion STRING, EMMA STRING")
    approved = spark.createDataFrame([("2.0",), (None,)], "Value STRING")
    assert issues(T.issue_report_v1(telemetry, people, clients, approved, AS_OF)) == {
        ("p", T.SPEAKER, "Jabra", "Last 24 hours"), ("p", T.DISPLAY, "10 x 20", "Last 24 hours"),
        ("p", T.BUILD, "b9", "Last 24 hours"), ("p", T.CLIENT, "1.0", "Last 24 hours")}


def test_report_v2_judges_every_recent_row(spark):
    telemetry = rows(
        spark,
        {"latencyAverage": 1.0, "citrixClientVersion": " 2.0 ", "audioDeviceComposite": "T2', 'b9','x"},
        {"timeStamp": datetime(2025, 1, 10), "latencyAverage": 1.0, "remoteHostName": "h", "gateway": "w", "monitorLayoutCount": 1,
         "monitorLayoutWidth": 4000, "monitorLayoutHeight": 1},
        {"latencyAverage": 1.0}, {"latencyAverage": 50.0}, {"timeStamp": datetime(2024, 1, 1), "latencyAverage": 900.0})
    people = spark.createDataFrame([("p",)], "gpin STRING")
    clients = spark.createDataFrame([("b1", "x"), ("b2", "x")], "BuildVersion STRING, EMMA STRING")
    supported = spark.createDataFrame([("2.0",)], "Value STRING")
    lookup = spark.createDataFrame([("h", "w", "b7")], "HostName STRING, Gateway STRING, buildVersion STRING")
    assert issues(T.issue_report_v2(telemetry, people, clients, supported, lookup, AS_OF)) == {
        ("p", T.BUILD, "b9", "Last 24 hours"), ("p", T.BUILD, "b7", "Last 30 days"),
        ("p", T.DISPLAY, "1 x 4000 x 1", "Last 30 days"), ("p", T.LATENCY, "50.0", "Last 24 hours")}


def test_active_rules_in_order(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", "t", "active")], "id STRING, deletedDateTime STRING, state STRING")
    assert [r.id for r in P.active_only(df).collect()] == ["a"]
    assert [r.id for r in P.active_only(df.drop("deletedDateTime")).collect()] == ["b"]
    assert P.active_only(df.select("id")).count() == 2


def test_tombstones_and_file_names(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "removed BOOLEAN")
    assert [r[0] for r in df.where(P.live("removed")).collect()] == [False, None]
    assert column(spark, ['a\\b/c*d?e:f"g<h>i|j']).select(C.file_safe(F.col("v"))).first()[0] == "abcdefghij"


def test_changed_since_without_a_baseline_gives_nothing(spark):
    df = spark.createDataFrame([(1, AS_OF)], "id INT, ts TIMESTAMP_NTZ")
    assert P.changed_since(df, "ts", df.where("id = 2"), "ts").count() == 0
    assert P.changed_since(df, "ts", df, "ts").count() == 1


def test_run_ids():
    assert C.new_run_id("feed", datetime(2025, 1, 2, 3, 4, 5), "abc") == "feed_20250102T030405_abc"
    assert C.new_run_id("x") != C.new_run_id("x")
