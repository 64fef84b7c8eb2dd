"""Queries that write derived data to the shared folder and read it back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline import schemas
from rosterline.functions import columns as C, predicates as P
from rosterline.operators.increments import land_batches, landed_marks
from rosterline.operators.keyed import in_chunks, mapped_rows, numbered
from rosterline.operators.quality import batch_progress
from rosterline.operators.runlog import RunLog
from rosterline.plans import inputs
from rosterline.plans.histories import MEMBER
from rosterline.plans.registry import query, table
from rosterline.sinks import tables as sinks
from rosterline.sources import pages as feed, snapshots, tables as sources
from rosterline.streaming.feed_store import FeedStore
from rosterline.streaming.jobs import follow_feed, ingest_files
from rosterline.workspace import fresh_dir, sized

SNAPSHOT_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
DAY = ["year", "month", "day"]


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly snapshots, dated to the first of the month."""
    ordered = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year(ordered).alias("year"), F.month(ordered).alias("month"), F.lit(1).alias("day"),
    )


def _landed_snapshots(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "snapshots")
    sinks.replace_partitions(_monthly(spark, sf_dir), path, DAY, "json")
    return path


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 1997 AS year, 5 AS month, 1 AS day
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'
""")
def snapshot_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_snapshots(spark, sf_dir)
    declared = f"{SNAPSHOT_DDL}, {schemas.CORRUPT_COLUMN} STRING, {schemas.PARTITION_DDL}"
    day = snapshots.read_snapshot(spark, path, declared, snapshots.parse_day("1997-05-01"))
    absent = snapshots.read_snapshot(spark, f"{path}-absent", declared)
    return day.unionByName(absent).drop(schemas.CORRUPT_COLUMN)


@query("""
SELECT o_orderkey, TIMESTAMP '2024-01-31' AS ingestion_timestamp, 'year=1997/month=5/day=1' AS partition,
       DATE '1997-05-01' AS snapshot_date, 1997 AS snapshot_year, 5 AS snapshot_month, 1 AS snapshot_day
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'
""")
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = f"{SNAPSHOT_DDL}, {schemas.PARTITION_DDL}"
    day = date(1997, 5, 1)
    rows = snapshots.read_snapshot(spark, _landed_snapshots(spark, sf_dir), declared, day)
    added = snapshots.with_ingest_columns(rows, inputs.AS_OF, day)
    return added.select(
        "o_orderkey", "ingestion_timestamp",
        F.regexp_extract("source_file_name", r"(year=\d+/month=\d+/day=\d+)", 1).alias("partition"),
        "snapshot_date", "snapshot_year", "snapshot_month", "snapshot_day",
    )


@query("""
SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS n, sum(CAST(o_orderkey AS BIGINT))::BIGINT AS keys
FROM orders GROUP BY 1, 2
""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "replace")
    rows = _monthly(spark, sf_dir)
    sinks.replace_partitions(rows, path, DAY)
    sinks.replace_partitions(rows.where("year = 1997 AND month = 5"), path, DAY)
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def raw_json_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = snapshots.with_row_json(table(spark, sf_dir, "customer")).select("_raw_json")
    return snapshots.parse_json_columns(
        captured, "_raw_json",
        {
            "c_custkey": ("c_custkey", "bigint"), "c_name": ("c_name", "string"),
            "c_nationkey": ("c_nationkey", "int"), "c_acctbal": ("c_acctbal", "double"),
            "c_mktsegment": ("c_mktsegment", "string"),
        },
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    return snapshots.parse_json_columns(rows, "props", {"k": ("k", "int")})


@query("SELECT event_id, user_id, event_type FROM events")
def append_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "append")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    sinks.append(rows.where("event_type <> 'error'"), path)
    sinks.append(rows.where("event_type = 'error'"), path)
    return sources.read_table(spark, path)


@query("""
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer
""")
def schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "evolve")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    sinks.append(rows.where("c_acctbal < 0").select("c_custkey", "c_name"), path)
    sinks.append(rows.where("c_acctbal >= 0").drop("c_acctbal"), path)
    return sinks.read_evolved(spark, path, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING")


@query("SELECT DISTINCT p_brand AS role_definition_id, p_type AS permission_label FROM part")
def type1_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_dir(spark, "type1")
    parts = table(spark, sf_dir, "part")
    sinks.write_version(parts.select("p_partkey", F.col("p_brand").alias("role_definition_id")), base)
    current = parts.select(F.col("p_type").alias("permission_label"), F.col("p_brand").alias("role_definition_id"))
    sinks.write_version(current.distinct(), base, columns=["role_definition_id", "permission_label"])
    sinks.write_version(sinks.read_version(spark, base), base)
    return sinks.read_version(spark, base)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def compact_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "compact")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    sinks.compact(rows, path, ["l_partkey"])
    return spark.read.schema(rows.schema).parquet(path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def table_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "scan")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    empty = schemas.empty_table(spark, rows.schema)
    sinks.append(empty.unionByName(rows), path)
    stored = sources.read_table(spark, path)
    stored.createOrReplaceTempView("rosterline_suppliers")
    return sources.read_table(spark, "rosterline_suppliers")


@query("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def compressed_report_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "report")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    return sources.read_report(spark, path, rows.schema)


@query(r"""
SELECT regexp_replace(p_brand || '/' || p_type || '?', '[\\/*?:"<>|]', '', 'g') AS report,
       count(*) AS n, sum(p_partkey)::BIGINT AS keys
FROM part GROUP BY 1
""")
def report_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "per-report")
    title = F.concat("p_brand", F.lit("/"), "p_type", F.lit("?"))
    rows = table(spark, sf_dir, "part").select("p_partkey", title.alias("title"))
    sinks.write_per_report(rows, path, "title")
    stored = spark.read.schema("p_partkey BIGINT, title STRING, report STRING").parquet(path)
    return stored.groupBy("report").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"))


# --- change-feed pages -------------------------------------------------------------------

PAGE_ROWS, BATCH_ROWS = 100, 1000

PAGES_SQL = """
rows AS (
  SELECT event_id, user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k,
         event_id // 1000 AS batch, (event_id % 1000) // 100 AS page FROM events),
ends AS (SELECT batch, max_by(event_type, event_id) AS last_type, max(event_id) AS last_id, max(ts) AS received
         FROM rows GROUP BY 1)"""


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as pages of 100 group records, ten pages to a batch.

    A batch whose last event is an error ends without a delta link: it was cut off.
    """
    key = F.get_json_object("props", "$.k").try_cast("bigint") % 10
    reason = F.when(F.col("event_type") == "error", F.struct(F.lit("deleted").alias("reason")))
    change = F.struct(key.cast("string").alias("id"), reason.alias("@removed"))
    rows = table(spark, sf_dir, "events").select(
        F.expr(f"event_id DIV {BATCH_ROWS}").alias("batch"),
        F.expr(f"(event_id % {BATCH_ROWS}) DIV {PAGE_ROWS}").alias("page_seq"),
        "event_id", "event_type", "ts",
        F.struct(F.col("user_id").cast("string").alias("id"), F.array(change).alias("members@delta")).alias("record"),
    )
    # A page holds at most 100 records, so a group is small whatever the table's size.
    packed = rows.groupBy("batch", "page_seq").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "record"))).alias("items"),
        F.max("event_id").alias("last_id"), F.max_by("event_type", "event_id").alias("last_type"),
        F.max("ts").alias("received_ts"),
    )
    ends = rows.groupBy("batch").agg(F.max("event_id").alias("batch_end"))
    is_last = F.col("last_id") == F.col("batch_end")
    link = F.concat(F.lit("token-"), F.col("batch"))
    envelopes = packed.join(ends, "batch").select(
        F.lit("groups").alias("scope"), F.col("batch").cast("string").alias("batch_id"), "page_seq", "received_ts",
        F.col("items.record").alias("value"),
        F.when(~is_last, F.concat(F.lit("next-"), F.col("last_id"))).alias("@odata.nextLink"),
        F.when(is_last & (F.col("last_type") != "error"), link).alias("@odata.deltaLink"),
    )
    path = fresh_dir(spark, "pages")
    _land(envelopes, path)
    return feed.read_pages(spark, path, schemas.GROUP_RECORD)


def _land(envelopes: DataFrame, path: str, partition_cols: tuple[str, ...] = ()) -> None:
    # Dealt out by folder, or every task would write a file into every folder.
    dealt = envelopes.hint("rebalance", *partition_cols) if partition_cols else envelopes
    written = dealt.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    (written.partitionBy(*partition_cols) if partition_cols else written).json(path)


@query(f"""
WITH {PAGES_SQL}
SELECT CAST(batch AS VARCHAR) AS batch_id, page AS page_seq, CAST(event_id % 100 AS INTEGER) AS position,
       CAST(user_id AS VARCHAR) AS group_id, CAST(k AS VARCHAR) AS member_id,
       CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS action
FROM rows JOIN ends USING (batch) WHERE last_type <> 'error'
""")
def change_page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feed.flatten_pages(landed_pages(spark, sf_dir))
    return feed.link_changes(records, "members@delta", "member_id").select(
        "batch_id", "page_seq", "position", "group_id", "member_id", "action"
    )


LANDED_SQL = PAGES_SQL + """,
runs AS (SELECT 'groups_20240131T000000_' || n AS run_id, n FROM range(1, 4) r(n)),
landed AS (
  SELECT rows.*, 'b' || lpad(CAST(batch AS VARCHAR), 6, '0') AS batch_id, last_type <> 'error' AS finished,
         CASE WHEN batch % 2 = 0 THEN 1 ELSE 2 END AS run
  FROM rows JOIN ends USING (batch)),
marks AS (
  SELECT batch % 3 AS scope, run, max(batch_id) AS mark FROM landed WHERE finished GROUP BY ALL),
taken AS (
  SELECT l.* FROM landed l LEFT JOIN (SELECT scope, mark FROM marks WHERE run = 1) m ON m.scope = l.batch % 3
  WHERE run = 1 OR mark IS NULL OR batch_id > mark)"""


def _lander(spark: SparkSession, sf_dir: str) -> tuple[str, str, RunLog]:
    """Three runs over batches of three scopes, even ones landed first, the odd ones before the second run.

    The third run finds nothing above the marks but what was cut off, and its store fails.
    """
    landing, rows_path, marks, events = (fresh_dir(spark, name) for name in ("landing", "landed-rows", "marks", "events"))
    number = F.col("batch_id").cast("bigint")
    pages = landed_pages(spark, sf_dir).withColumnsRenamed({"next_link": "@odata.nextLink", "delta_link": "@odata.deltaLink"})
    pages = sized(pages.withColumn("number", number), "pages").select(
        (F.col("number") % 3).cast("string").alias("scope"), F.concat(F.lit("b"), F.lpad("batch_id", 6, "0")).alias("batch_id"),
        *[F.col(f"`{c}`") for c in pages.columns if c not in ("scope", "batch_id")], "number",
    )
    log = RunLog(spark, events)

    def rows(records: DataFrame) -> DataFrame:
        return feed.group_rows(records, keep=("scope", "batch_id", "received_ts"))

    def failing(records: DataFrame) -> DataFrame:
        raise RuntimeError("no room")

    for run, (part, turn) in enumerate(((0, rows), (1, rows), (None, failing)), 1):
        if part is not None:
            _land(pages.where(F.col("number") % 2 == part).drop("number"), landing, ("scope", "batch_id"))
        try:
            with log.step(C.new_run_id("groups", inputs.AS_OF, str(run)), "directory", "groups") as step:
                land_batches(spark, landing, schemas.GROUP_RECORD, turn, rows_path, marks, inputs.RUN_1, step)
        except RuntimeError:
            pass
    return rows_path, marks, log


@query(f"""
WITH {LANDED_SQL}
SELECT 'rows' AS part, CAST(batch % 3 AS VARCHAR) AS scope, batch_id, count(*) AS n, NULL AS token, NULL::TIMESTAMP AS since
FROM taken WHERE finished GROUP BY ALL
UNION ALL
SELECT 'mark', CAST(batch % 3 AS VARCHAR), max(batch_id), NULL, 'token-' || max(batch), TIMESTAMP '2002-01-01' FROM landed WHERE finished GROUP BY ALL
""")
def landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs of the lander, seeded from a snapshot, stored, and where their marks stand."""
    rows_path, marks, _ = _lander(spark, sf_dir)
    stored = spark.read.schema("group_id STRING, scope STRING, batch_id STRING").parquet(rows_path)
    counted = stored.groupBy("scope", "batch_id").agg(F.count(F.lit(1)).alias("n"))
    reached = landed_marks(spark, marks)
    rows = counted.select(F.lit("rows").alias("part"), "scope", "batch_id", "n")
    reached = reached.select(
        F.lit("mark").alias("part"), "scope", "batch_id", F.col("delta_link").alias("token"), F.col("snapshot_filter_from").alias("since")
    )
    return rows.unionByName(reached, allowMissingColumns=True)


@query(f"""
WITH {LANDED_SQL},
seen AS (
  SELECT 'groups_20240131T000000_1' AS run_id, * EXCLUDE (run) FROM landed WHERE run = 1
  UNION ALL SELECT 'groups_20240131T000000_2', * EXCLUDE (run) FROM taken WHERE run = 2
  UNION ALL SELECT 'groups_20240131T000000_2', l.* EXCLUDE (run) FROM landed l LEFT JOIN (SELECT scope, mark FROM marks WHERE run = 1) m ON m.scope = l.batch % 3
    WHERE run = 1 AND (mark IS NULL OR batch_id > mark)
  UNION ALL SELECT 'groups_20240131T000000_3', l.* EXCLUDE (run) FROM landed l
    LEFT JOIN (SELECT scope, max(mark) AS mark FROM marks GROUP BY 1) m ON m.scope = l.batch % 3 WHERE mark IS NULL OR batch_id > mark)
SELECT run_id, 'START' AS event, NULL AS scope, NULL AS batch_id, NULL AS page_seq, NULL AS records, NULL AS notes FROM runs
UNION ALL
SELECT run_id, 'PAGE', CAST(batch % 3 AS VARCHAR), batch_id, page, count(*), NULL FROM seen GROUP BY ALL
UNION ALL
SELECT r.run_id, CASE WHEN n = 3 AND EXISTS (SELECT 1 FROM seen s WHERE s.run_id = 'groups_20240131T000000_3') THEN 'FAIL' ELSE 'SUCCESS' END, NULL, NULL, NULL,
  CASE WHEN n = 3 THEN 0 ELSE (SELECT count(*) FROM seen s WHERE s.run_id = r.run_id AND finished) END,
  CASE WHEN n = 3 AND EXISTS (SELECT 1 FROM seen s WHERE s.run_id = 'groups_20240131T000000_3') THEN 'RuntimeError: no room' END
FROM runs r
""")
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of these runs: a START each, every page they read, and how they ended."""
    _, _, log = _lander(spark, sf_dir)
    return log.events().select("run_id", "event", "scope", "batch_id", "page_seq", "records", "notes")


@query(f"""
WITH {PAGES_SQL}
SELECT CAST(batch AS VARCHAR) AS batch_id, CASE WHEN last_type <> 'error' THEN 'SUCCESS' ELSE 'FAIL' END AS event,
       count(DISTINCT page) AS pages, count(*) AS records, 'groups' AS scope
FROM rows JOIN ends USING (batch) GROUP BY batch, last_type
""")
def batch_page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_progress(feed.batch_status(landed_pages(spark, sf_dir)))


# --- fan-out per key ---------------------------------------------------------------------


@query("""
WITH wanted AS (SELECT c_custkey AS key FROM customer),
owners AS (SELECT o_custkey AS key, o_orderkey, o_orderstatus FROM orders),
complete AS (SELECT key FROM owners GROUP BY 1 HAVING max_by(o_orderstatus, o_orderkey) <> 'P')
SELECT w.key, CAST(o.o_orderkey AS VARCHAR) AS owner_id, w.key IN (SELECT key FROM complete) AS key_complete
FROM wanted w LEFT JOIN owners o ON w.key = o.key
""")
def keyed_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as groups, their orders as owner pages; a page spans 500 order keys."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    paged = orders.groupBy(F.col("o_custkey").alias("key"), F.expr("o_orderkey DIV 500").alias("slot")).agg(
        F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("id"))).alias("value"),
        F.max_by("o_orderstatus", "o_orderkey").alias("last_status"),
    )
    ends = paged.groupBy("key").agg(F.max("slot").alias("end"))
    landed = numbered(paged, ["key"], "slot", in_chunks("slot"), "page_seq").join(ends, "key")
    pages = landed.select(
        "key", "page_seq", "value",
        F.lit(None).cast("timestamp_ntz").alias("received_ts"), F.lit(None).cast("string").alias("error"),
        F.when((F.col("slot") == F.col("end")) & (F.col("last_status") != "P"), "token").alias("delta_link"),
    )
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return feed.fan_out(wanted, pages, "key").select("key", F.col("record.id").alias("owner_id"), "key_complete")


@query("""
SELECT o_custkey, CAST(n AS BIGINT) AS n, o_custkey * 10 + n AS code, NULL::VARCHAR AS error
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 17 <> 0), range(4) r(n) WHERE n < o_custkey % 4
UNION ALL
SELECT o_custkey, NULL, NULL, 'KeyError(''no such key'')'
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 17 = 0)
""")
def keyed_python_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    def lookup(key):
        if key % 17 == 0:
            raise KeyError("no such key")
        return [(n, key * 10 + n) for n in range(key % 4)]

    return mapped_rows(table(spark, sf_dir, "orders"), ["o_custkey"], lookup, "n BIGINT, code BIGINT", "o_custkey BIGINT")


# --- streams -----------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
       "CAST(day(ts) AS INTEGER) AS day FROM events")
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, target, checkpoint = (fresh_dir(spark, name) for name in ("landing", "ingested", "progress"))
    ts = F.col("ts")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
    )
    sinks.replace_partitions(rows, landing, DAY, "json")
    for _ in range(2):
        ingest_files(spark, landing, rows.schema, target, checkpoint, DAY)
    return spark.read.parquet(target).select(*rows.columns)


@query(f"WITH {inputs.MEMBERSHIP_SQL} SELECT * FROM membership")
def stream_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions landed in four spans of time; every landing is applied before the next."""
    landing, base, checkpoint = (fresh_dir(spark, name) for name in ("actions", "history", "progress"))
    rows = inputs.actions(spark, sf_dir)
    store = FeedStore(spark, base, "group_id BIGINT, member_id BIGINT", fanout=2)
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = rows.agg(F.min(second).alias("first"), F.max(second).alias("last")).first()
    width = ((span["last"] or 0) - (span["first"] or 0)) // 4 + 1
    for part in range(4):
        sinks.append(rows.where(F.floor((second - (span["first"] or 0)) / width) == part), landing)
        follow_feed(spark, landing, rows.schema, store, checkpoint, "ts", "event_id", F.col("action") == "remove")
    return store.versions()


@query(f"WITH {inputs.MEMBERSHIP_SQL} SELECT * FROM membership")
def late_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same actions dealt to five batches without regard to time: every batch reaches back."""
    rows = inputs.actions(spark, sf_dir)
    store = FeedStore(spark, fresh_dir(spark, "late"), "group_id BIGINT, member_id BIGINT", fanout=2)
    for part in range(5):
        batch = rows.where((F.col("event_id") * 7 + F.col("group_id")) % 5 == part)
        store.apply(part, batch, "ts", "event_id", F.col("action") == "remove")
    return store.versions()


# --- columns and predicates --------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus AS state FROM orders WHERE o_orderstatus = 'O'")
def active_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "O", "active").otherwise("deleted")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", state.alias("state"))
    return P.active_only(rows).select("o_orderkey", F.col("o_orderstatus").alias("state"))


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def tombstone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.when(F.col("event_type") == "error", True)
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", removed.alias("removed"))
    return rows.where(P.live("removed")).drop("removed")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS changed_at FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'signup' AND user_id = 3)
""")
def changed_since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    baseline = events.where("event_type = 'signup' AND user_id = 3")
    return P.changed_since(events, "ts", baseline, "ts").select("event_id", C.iso_text(F.col("ts")).alias("changed_at"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, date_trunc('second', ts) AS parsed,
       CAST(ts AS DATE) AS day, year(ts)::INTEGER AS y, month(ts)::INTEGER AS m, day(ts)::INTEGER AS d
FROM events
""")
def timestamp_parse_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = C.iso_text(F.col("ts"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"), F.to_date("ts").alias("day"))
    parsed = F.try_to_timestamp("text", F.lit(C.ISO_FORMAT)).cast("timestamp_ntz")
    return rows.select(
        "event_id", "text", parsed.alias("parsed"), "day", F.year("day").alias("y"), F.month("day").alias("m"),
        F.dayofmonth("day").alias("d"),
    )


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'User'
                      WHEN event_type = 'purchase' THEN 'Group' ELSE 'Other' END AS principal_type
FROM events
""")
def principal_type_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    marker = F.when(kind.isin("click", "view"), C.USER_MARKER).when(kind == "purchase", C.GROUP_MARKER).when(kind == "error", "")
    rows = table(spark, sf_dir, "events").select("event_id", marker.alias("odata_type"))
    return rows.select("event_id", C.principal_type(F.col("odata_type")).alias("principal_type"))


@query(r"""SELECT page_id, regexp_replace(url, '[\\/*?:"<>|]', '', 'g') AS name FROM pages""")
def filename_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", C.file_safe(F.col("url")).alias("name"))


@query("""
SELECT c_custkey AS user_object_id, c_name AS display_name, CAST(c_nationkey AS VARCHAR) AS metric,
       c_acctbal * 2 + 1 AS scaled, c_acctbal > 0 AS account_enabled
FROM customer
""")
def project_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_object_id"), F.col("c_name").alias("display_name"),
        F.col("c_nationkey").cast("string").alias("metric"), (F.col("c_acctbal") * 2 + 1).alias("scaled"),
        (F.col("c_acctbal") > 0).cast("string").try_cast("boolean").alias("account_enabled"),
    )


@query("""
WITH parts AS (SELECT doc_id, list_transform(string_split(text, ','), lambda x: trim(x, ' ')) AS items FROM documents),
counts AS (SELECT item, count(*) AS n FROM (SELECT unnest(items) AS item FROM parts) GROUP BY 1),
holders AS (SELECT count(*) AS n FROM parts WHERE list_contains(items, ''))
SELECT item, n FROM counts UNION ALL SELECT '<documents with an empty part>', n FROM holders
""")
def array_column_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "documents").select("doc_id", C.values_of(F.col("text")).alias("items"))
    counts = parts.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    holders = parts.where(F.array_contains("items", "")).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(holders.select(F.lit("<documents with an empty part>").alias("item"), "n"))
