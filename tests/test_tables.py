"""Readers, writers and streams."""

import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterline import schemas, workspace
from rosterline.sinks import tables as S
from rosterline.sources import snapshots, tables
from rosterline.streaming.jobs import ingest_files

def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_snapshot_reads_one_day_and_keeps_corrupt_lines(spark, tmp_path):
    for day, lines in ((1, '{"GroupId":"g","MemberId":"m"}\n{bad'), (2, '{"GroupId":"h","MemberId":"n"}')):
        folder = tmp_path / f"year=2025/month=03/day=0{day}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(lines)
    spec = schemas.DATASETS["group_members_v0"]
    day = snapshots.read_snapshot(spark, str(tmp_path), spec.read_schema, date(2025, 3, 1)).cache()
    assert {(r.GroupId, r[schemas.CORRUPT_COLUMN]) for r in day.collect()} == {("g", None), (None, "{bad")}
    assert snapshots.read_snapshot(spark, str(tmp_path), spec.read_schema).count() == 3
    missing = snapshots.read_snapshot(spark, str(tmp_path / "none"), spec.read_schema)
    assert missing.isEmpty() and missing.columns == day.columns


def test_only_the_wanted_day_is_scanned(spark, tmp_path):
    rows = spark.range(10).select("id", F.lit(2025).alias("year"), F.lit(1).alias("month"), (F.col("id") % 5).cast("int").alias("day"))
    S.replace_partitions(rows, str(tmp_path / "t"), ["year", "month", "day"])
    day = snapshots.read_snapshot(spark, str(tmp_path / "t"), "id BIGINT, year INT, month INT, day INT", date(2025, 1, 3), "parquet")
    assert day.count() == 2 and all("/day=3/" in name for name in day.inputFiles())
    none = snapshots.read_snapshot(spark, str(tmp_path / "t"), "id BIGINT, year INT, month INT, day INT", date(2025, 1, 9), "parquet")
    assert none.count() == 0


@pytest.mark.parametrize("text", ["2025-13-01", "20250101", "2025-02-30", ""])
def test_bad_dates_are_refused(text):
    with pytest.raises(ValueError):
        snapshots.parse_day(text)


def test_json_values_that_do_not_fit_are_null(spark):
    df = spark.createDataFrame([('{"a": "yes", "b": true, "c": "12"}',), ("no json",)], "raw STRING")
    got = snapshots.parse_json_columns(df, "raw", {"a": ("a", "int"), "b": ("b", "boolean"), "c": ("c", "bigint")})
    assert as_set(got) == {(None, True, 12), (None, None, None)}


def test_replace_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_partitions(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    S.replace_partitions(spark.range(100, 103).withColumn("p", F.lit(1).cast("bigint")), path, ["p"])
    S.replace_partitions(spark.range(100, 103).withColumn("p", F.lit(1).cast("bigint")), path, ["p"])
    assert {r.id for r in spark.read.parquet(path).collect()} == {0, 2, 4, 6, 8, 100, 101, 102}


def test_versions_may_read_the_one_before_and_change_schema(spark, tmp_path):
    base = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        S.read_version(spark, base)
    assert S.write_version(spark.range(3), base) == 1
    assert S.write_version(S.read_version(spark, base).select((F.col("id") + 1).alias("n"), F.lit("x").alias("t")), base, ["t", "n"]) == 2
    assert S.read_version(spark, base).columns == ["t", "n"] and S.read_version(spark, base, 1).columns == ["id"]


def test_unfinished_version_is_not_read(spark, tmp_path):
    base = tmp_path / "v"
    S.write_version(spark.range(3), str(base))
    (base / "version=2").mkdir()
    assert S.read_version(spark, str(base)).count() == 3
    assert S.write_version(spark.range(4), str(base)) == 2


def test_compaction_keeps_rows_and_cuts_a_hot_key(spark, tmp_path):
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).repartition(20)
    S.compact(rows, str(tmp_path / "c"), ["k"], files=4)
    files = list((tmp_path / "c").glob("part-*.parquet"))
    assert len(files) == 4
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert stored.count() == 4000 and stored.distinct().count() == 4000
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 2000


def test_gzip_report_with_byte_order_mark(spark, tmp_path):
    lines = "DeviceName,UserPrincipalName\r\nlaptop,\"a, b\"\r\n"
    (tmp_path / "r.csv.gz").write_bytes(gzip.compress(lines.encode("utf-8-sig")))
    got = tables.read_report(spark, str(tmp_path), "DeviceName STRING, UserPrincipalName STRING")
    assert as_set(got) == {("laptop", "a, b")}


def test_jdbc_reader_asks_for_partitions(monkeypatch):
    calls = []

    class Reader:
        def jdbc(self, **options):
            calls.append(options)

    class Session:
        read = Reader()

    tables.read_jdbc_table(Session(), "jdbc:x", "t", column="id", bounds=(0, 10), partitions=5)
    tables.read_jdbc_table(Session(), "jdbc:x", "small", {"user": "u"})
    assert calls[0]["numPartitions"] == 5 and calls[0]["upperBound"] == 10 and calls[0]["column"] == "id"
    assert "column" not in calls[1] and calls[1]["properties"]["user"] == "u"


def test_intermediate_tables_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    first, second = workspace.fresh_dir(spark, "x"), workspace.fresh_dir(spark, "x")
    assert first != second
    if configured:
        assert first.startswith(configured)


def test_each_file_is_ingested_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("s", "t", "p"))
    schema = "id BIGINT, year INT, month INT, day INT"
    rows = spark.range(6).select("id", F.lit(2025).alias("year"), F.lit(1).alias("month"), (F.col("id") % 2).cast("int").alias("day"))
    S.replace_partitions(rows, source, ["year", "month", "day"], "json")
    ingest_files(spark, source, schema, target, progress)
    ingest_files(spark, source, schema, target, progress)
    assert spark.read.parquet(target).count() == 6
    rows.withColumn("id", F.col("id") + 100).write.mode("append").partitionBy("year", "month", "day").json(source)
    ingest_files(spark, source, schema, target, progress, files_per_batch=1)
    stored = spark.read.parquet(target)
    assert stored.count() == 12 and {"source_file", "ingest_ts"} <= set(stored.columns)


def test_reports_never_share_a_folder(spark, tmp_path):
    titles = ["a:b", "ab", "a?b", "plain", "", None, ":", "ab"]
    df = spark.createDataFrame(list(enumerate(titles)), "n INT, title STRING")
    S.write_per_report(df, str(tmp_path / "r"), "title")
    rows = spark.read.parquet(str(tmp_path / "r")).collect()
    assert len(rows) == len(titles) and all(r.report for r in rows)
    by_folder = {}
    for r in rows:
        by_folder.setdefault(r.report, set()).add(r.title)
    assert all(len(found) == 1 for found in by_folder.values()) and len(by_folder) == 7
    assert "plain" in by_folder and sum(name.startswith("ab-") for name in by_folder) == 3


def test_landed_batches_have_one_file_each(spark, tmp_path):
    from rosterline.plans import ingest

    rows = spark.range(400).selectExpr("'s' AS scope", "concat('b', id % 20) AS batch_id", "id AS page_seq").repartition(8, "page_seq")
    ingest._land(rows, str(tmp_path / "landing"), ("scope", "batch_id"))
    folders = sorted((tmp_path / "landing" / "scope=s").glob("batch_id=*"))
    assert [len(list(f.glob("part-*"))) for f in folders] == [1] * 20
    assert spark.read.json(str(tmp_path / "landing")).count() == 400
