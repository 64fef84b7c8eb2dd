"""Queries of the quality checks, the run log and incremental control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.operators import increments as L, quality as Q
from rosterline.plans import inputs
from rosterline.plans.histories import MEMBER, membership
from rosterline.plans.registry import query, table
from rosterline.products import directory
from rosterline.workspace import fresh_dir, sized


@query("""
WITH owners AS (SELECT o_orderkey, nullif(o_custkey, 3) AS o_custkey FROM orders)
SELECT 'Null c_custkey in customer' AS rule, count(*) FILTER (WHERE c_custkey IS NULL) AS violations FROM customer
UNION ALL SELECT 'Null o_orderkey in orders', count(*) FILTER (WHERE o_orderkey IS NULL) FROM owners
UNION ALL SELECT 'Null o_custkey in orders', count(*) FILTER (WHERE o_custkey IS NULL) FROM owners
UNION ALL SELECT 'Null event_id in events', count(*) FILTER (WHERE event_id IS NULL) FROM events
""")
def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_custkey", F.lit(3)).alias("o_custkey"))
    return Q.null_keys(
        {
            "customer": (table(spark, sf_dir, "customer"), ["c_custkey"]),
            "orders": (owners, ["o_orderkey", "o_custkey"]),
            "events": (table(spark, sf_dir, "events"), ["event_id"]),
        }
    )


@query("""
SELECT 'lineitem' AS tbl, l_orderkey AS key, l_linenumber AS part, count(*) AS row_count FROM lineitem
GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL
SELECT 'orders', o_orderkey, 0, count(*) FROM orders GROUP BY 2 HAVING count(*) > 1
""")
def dq_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Q.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        F.lit("lineitem").alias("tbl"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("part"), "row_count"
    )
    orders = Q.duplicate_keys(table(spark, sf_dir, "orders"), ["o_orderkey"]).select(
        F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("key"), F.lit(0).alias("part"), "row_count"
    )
    return lines.unionByName(orders)


@query(f"""
WITH {inputs.MEMBERSHIP_SQL},
spoiled AS (
  SELECT group_id, member_id, valid_from,
         CASE WHEN group_id % 5 = 0 THEN valid_to + INTERVAL 3 DAY ELSE valid_to END AS valid_to,
         is_current OR member_id = 7 AS is_current FROM membership),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY group_id, member_id ORDER BY valid_from, valid_to NULLS FIRST) AS n FROM spoiled),
pairs AS (
  SELECT * , EXISTS (
    SELECT 1 FROM ordered b WHERE b.group_id = a.group_id AND b.member_id = a.member_id AND b.n < a.n
      AND (b.valid_to IS NULL OR b.valid_to > a.valid_from)) AS late
  FROM ordered a WHERE group_id IS NOT NULL AND member_id IS NOT NULL)
SELECT 'ends before it starts' AS rule, count(*) FILTER (WHERE valid_to <= valid_from) AS violations FROM pairs
UNION ALL SELECT 'overlaps an earlier version', count(*) FILTER (WHERE late) FROM pairs
UNION ALL SELECT 'current with an end', count(*) FILTER (WHERE is_current AND valid_to IS NOT NULL) FROM pairs
UNION ALL SELECT 'more than one current', count(*) FROM (
  SELECT 1 FROM spoiled WHERE is_current GROUP BY group_id, member_id HAVING count(*) > 1)
""")
def dq_validity_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The membership history with known damage: late ends in some groups, one member always current."""
    late = F.when(F.col("group_id") % 5 == 0, F.col("valid_to") + F.expr("INTERVAL 3 DAY")).otherwise(F.col("valid_to"))
    spoiled = membership(spark, sf_dir).withColumns(
        {"valid_to": late, "is_current": F.col("is_current") | (F.col("member_id") == 7)}
    )
    return Q.validity_violations(spoiled, MEMBER)


@query("""
SELECT 'feed' || (user_id % 10) AS source, event_type AS entity, count(*) AS runs,
       count(*) FILTER (WHERE value < 5) AS failures,
       CAST(sum(CASE WHEN value >= 5 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END) AS BIGINT) AS rows_ingested,
       max(ts) FILTER (WHERE value >= 5) AS last_success
FROM events GROUP BY 1, 2
""")
def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.concat(F.lit("feed"), F.col("user_id") % 10).alias("source"), F.col("event_type").alias("entity"),
        F.when(F.col("value") < 5, "FAILED").otherwise("SUCCESS").alias("status"), F.col("ts").alias("ended_at"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("rows_ingested"),
    )
    return Q.run_summary(runs)


@query("""
SELECT 'new' AS step, scope, count(*) AS n, max(event_id) AS top FROM (
  SELECT 'scope' || (user_id % 5) AS scope, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16' OR user_id % 5 = 4)
GROUP BY scope
UNION ALL
SELECT 'mark', 'scope' || (user_id % 5), NULL, max(event_id) FROM events GROUP BY 2
""")
def high_water_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks stand at mid-month for all scopes but one, which has none and is read whole."""
    feed = table(spark, sf_dir, "events").select(
        F.concat(F.lit("scope"), F.col("user_id") % 5).alias("scope"), "event_id", "ts"
    )
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    marks = feed.where((F.col("ts") < middle) & (F.col("scope") != "scope4")).groupBy("scope").agg(
        F.max("event_id").alias("mark")
    )
    marks = sized(marks, "marks")
    taken = L.above_mark(feed, marks, "scope", "event_id")
    report = taken.groupBy("scope").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("top"))
    moved = L.next_marks(marks, taken, "scope", "event_id")
    return report.select(F.lit("new").alias("step"), "scope", "n", "top").unionByName(
        moved.select(F.lit("mark").alias("step"), "scope", F.lit(None).cast("bigint").alias("n"), F.col("mark").alias("top"))
    )


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT user_id FROM events
  WHERE CASE WHEN ts < TIMESTAMP '2024-01-25' THEN 'seed_' ELSE 'incr_' END || CAST(day(ts) AS VARCHAR) =
        (SELECT arg_max(CASE WHEN ts < TIMESTAMP '2024-01-25' THEN 'seed_' ELSE 'incr_' END || CAST(day(ts) AS VARCHAR), ts) FROM events))
""")
def changed_keys_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    kind = F.when(ts < F.lit("2024-01-25").cast("timestamp_ntz"), "seed_").otherwise("incr_")
    feed = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("o_custkey"), F.concat(kind, F.dayofmonth(ts)).alias("delta_batch_id"),
        ts.alias("received_ts"),
    )
    changed = L.latest_batch_keys(feed, "o_custkey")
    children = L.BucketedChildren(spark, fresh_dir(spark, "children"), "o_orderkey BIGINT, o_custkey BIGINT", "o_custkey")
    children.store(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return children.of(changed).select("o_orderkey", "o_custkey")


@query("""
SELECT 'Null user_object_id in dim_user' AS rule, count(*) FILTER (WHERE event_id % 9 = 0) AS violations FROM events
UNION ALL SELECT 'Null aad_group_id in dim_aad_group', 0
""")
def dq_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the directory dimensions, on users some of whose ids are missing."""
    users = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 9 != 0, F.concat(F.lit("u"), "user_id")).alias("user_object_id"))
    groups = table(spark, sf_dir, "supplier").select(F.concat(F.lit("g"), "s_suppkey").alias("aad_group_id"))
    return directory.directory_checks(users, groups)
