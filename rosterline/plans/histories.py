"""Queries over versioned tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.operators import history as H
from rosterline.plans import inputs
from rosterline.plans.registry import query, table
from rosterline.workspace import sized

PAIR = ["group_id", "owner_id"]
MEMBER = ["group_id", "member_id"]
STATE = ["owner_state"]


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.bridge_from_actions(inputs.actions(spark, sf_dir), MEMBER, "action", "ts", "event_id", unique_ts=True)


@query(f"""
WITH {inputs.SNAPSHOTS_SQL}
SELECT group_id, owner_id, owner_state, TIMESTAMP '1998-01-01' AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM s0
""")
def scd2_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, _ = inputs.owner_snapshots(spark, sf_dir)
    return H.bootstrap(first, inputs.RUN_0)


APPLIED_SQL = """
pairs AS (
  SELECT coalesce(s0.group_id, s1.group_id) AS group_id, coalesce(s0.owner_id, s1.owner_id) AS owner_id,
         s0.owner_state AS old_state, s1.owner_state AS new_state,
         s0.group_id IS NOT NULL AS was, s1.group_id IS NOT NULL AS now_there
  FROM s0 FULL JOIN s1 ON s0.group_id = s1.group_id AND s0.owner_id = s1.owner_id)
SELECT group_id, owner_id, old_state AS owner_state, TIMESTAMP '1998-01-01' AS valid_from,
       CASE WHEN {ends} THEN TIMESTAMP '2002-01-01' END AS valid_to, NOT ({ends}) AS is_current
FROM pairs WHERE was
UNION ALL
SELECT group_id, owner_id, new_state, TIMESTAMP '2002-01-01', NULL, TRUE
FROM pairs WHERE now_there AND (NOT was OR old_state IS DISTINCT FROM new_state)
"""


@query(f"WITH {inputs.SNAPSHOTS_SQL}," + APPLIED_SQL.format(
    ends="NOT now_there OR old_state IS DISTINCT FROM new_state"))
def scd2_snapshot_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = inputs.owner_snapshots(spark, sf_dir)
    return H.scd2_from_snapshot(H.bootstrap(first, inputs.RUN_0), second, PAIR, STATE, inputs.RUN_1)


@query(f"WITH {inputs.SNAPSHOTS_SQL}, complete AS (SELECT group_id FROM s1 GROUP BY 1 HAVING count(*) >= 3),"
       + APPLIED_SQL.format(
           ends="(NOT now_there AND group_id IN (SELECT group_id FROM complete))"
                " OR (now_there AND old_state IS DISTINCT FROM new_state)"))
def scd2_snapshot_partial_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = inputs.owner_snapshots(spark, sf_dir)
    complete = second.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").select("group_id")
    return H.scd2_from_snapshot(
        H.bootstrap(first, inputs.RUN_0), second, PAIR, STATE, inputs.RUN_1, complete=complete
    )


@query("""
WITH seen AS (
  SELECT user_id, event_type, ts, event_id,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events),
changes AS (
  SELECT * FROM seen
  WHERE CASE WHEN prev IS NULL THEN event_type <> 'error' ELSE event_type <> prev END),
timed AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM changes)
SELECT user_id, event_type, ts AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current
FROM timed WHERE event_type <> 'error'
""")
def scd2_feed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.scd2_from_feed(
        table(spark, sf_dir, "events"), ["user_id"], ["event_type"], "ts", "event_id",
        removed=F.col("event_type") == "error", unique_ts=True,
    )


@query(f"WITH {inputs.MEMBERSHIP_SQL} SELECT * FROM membership")
def bridge_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(spark, sf_dir)


@query(f"""
WITH {inputs.SNAPSHOTS_SQL}
SELECT group_id, owner_id, owner_state, TIMESTAMP '1998-01-01' AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM s0
UNION ALL
SELECT group_id, owner_id, owner_state, TIMESTAMP '2002-01-01', NULL, TRUE FROM s1
WHERE NOT EXISTS (SELECT 1 FROM s0 WHERE s0.group_id = s1.group_id AND s0.owner_id = s1.owner_id)
""")
def insert_if_no_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = inputs.owner_snapshots(spark, sf_dir)
    return H.insert_if_no_current(H.bootstrap(first, inputs.RUN_0), second, PAIR, inputs.RUN_1)


ASSIGNMENT = ["resource_id", "principal_id", "role_definition_id"]


@query("""
WITH rows AS (
  SELECT l_orderkey AS resource_id, l_suppkey AS principal_id, l_returnflag AS role_definition_id,
         max(l_linestatus) FILTER (WHERE l_shipdate < TIMESTAMP '1999-01-01') AS a,
         max(l_linestatus) FILTER (WHERE l_shipdate >= TIMESTAMP '1999-01-01') AS b
  FROM lineitem GROUP BY 1, 2, 3)
SELECT resource_id, principal_id, role_definition_id, a AS resource_type, TIMESTAMP '1998-01-01' AS valid_from,
       CASE WHEN a IS DISTINCT FROM b THEN TIMESTAMP '2002-01-01' END AS valid_to,
       a IS NOT DISTINCT FROM b AS is_current
FROM rows WHERE a IS NOT NULL
UNION ALL
SELECT resource_id, principal_id, role_definition_id, b, TIMESTAMP '2002-01-01', NULL, TRUE
FROM rows WHERE b IS NOT NULL AND a IS DISTINCT FROM b
""")
def assignment_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    split = F.lit("1999-01-01").cast("timestamp_ntz")

    def assignments(rows: DataFrame) -> DataFrame:
        return rows.groupBy(
            F.col("l_orderkey").alias("resource_id"), F.col("l_suppkey").alias("principal_id"),
            F.col("l_returnflag").alias("role_definition_id"),
        ).agg(F.max("l_linestatus").alias("resource_type"))

    first = H.bootstrap(assignments(lines.where(F.col("l_shipdate") < split)), inputs.RUN_0)
    second = assignments(lines.where(F.col("l_shipdate") >= split))
    second = sized(second, "assignments")
    # Stored between the runs: the next one reads a history in two parts.
    once = sized(H.scd2_from_snapshot(first, second, ASSIGNMENT, ["resource_type"], inputs.RUN_1), "assignment-history")
    return H.scd2_from_snapshot(once, second, ASSIGNMENT, ["resource_type"], datetime(2003, 1, 1))


@query("""
SELECT user_id % 7 AS scope, max_by(event_id, event_id) AS token, max_by(ts, event_id) AS synced_at
FROM events GROUP BY 1
""")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 7).alias("scope"), F.col("event_id").alias("token"), F.col("ts").alias("synced_at"),
        "event_type",
    )
    seeded = feed.where(F.col("event_type") == "signup").drop("event_type")
    state = H.latest_per_key(seeded, ["scope"], ["token"])
    return H.upsert_state(state, feed.drop("event_type"), ["scope"], ["token"])


@query(f"""
WITH {inputs.SNAPSHOTS_SQL}
SELECT CASE WHEN s0.group_id IS NULL THEN 'new' WHEN s1.group_id IS NULL THEN 'removed'
            WHEN s0.owner_state IS DISTINCT FROM s1.owner_state THEN 'changed' ELSE 'same' END AS change,
       count(*) AS n
FROM s0 FULL JOIN s1 ON s0.group_id = s1.group_id AND s0.owner_id = s1.owner_id GROUP BY 1
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = inputs.owner_snapshots(spark, sf_dir)
    return H.snapshot_diff(first, second, PAIR, STATE).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {inputs.SNAPSHOTS_SQL}
SELECT group_id, owner_id FROM s0
WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s0.group_id = s1.group_id AND s0.owner_id = s1.owner_id)
""")
def removed_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = inputs.owner_snapshots(spark, sf_dir)
    return first.select(*PAIR).join(second.select(*PAIR), PAIR, "left_anti")


@query(f"""
WITH {inputs.MEMBERSHIP_SQL}
SELECT * FROM membership
WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15')
""")
def history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.as_of(membership(spark, sf_dir), datetime(2024, 1, 15))


@query(f"WITH {inputs.MEMBERSHIP_SQL} SELECT * FROM membership WHERE group_id = 3")
def key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.key_history(membership(spark, sf_dir), {"group_id": 3})


@query(f"""
WITH {inputs.MEMBERSHIP_SQL}
SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current) AS current_rows,
       count(*) FILTER (WHERE NOT is_current) AS closed_rows
FROM membership
""")
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.version_counts(membership(spark, sf_dir))


@query("""
WITH seen AS (
  SELECT user_id, event_type, ts, event_id,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events),
changes AS (
  SELECT * FROM seen
  WHERE CASE WHEN prev IS NULL THEN event_type <> 'error' ELSE event_type <> prev END),
timed AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM changes),
versions AS (SELECT user_id, event_type AS state, ts AS valid_from, nxt AS valid_to FROM timed WHERE event_type <> 'error'),
probes AS (SELECT event_id, user_id, ts - INTERVAL 1 HOUR * (event_id % 50) AS asked_at FROM events)
SELECT event_id, p.user_id, asked_at, v.state, v.valid_from
FROM probes p LEFT JOIN versions v
  ON v.user_id = p.user_id AND v.valid_from <= asked_at AND (v.valid_to IS NULL OR v.valid_to > asked_at)
""")
def events_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every event the state its user was in up to two days earlier."""
    events = table(spark, sf_dir, "events")
    history = scd2_feed_history(spark, sf_dir).withColumnRenamed("event_type", "state")
    probes = events.select("event_id", "user_id", F.expr("ts - make_dt_interval(0, event_id % 50)").alias("asked_at"))
    return H.as_of_join(probes, history, ["user_id"], "asked_at", ["state", "valid_from"])
