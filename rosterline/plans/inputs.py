"""Inputs of the queries, derived from the given tables, and the same inputs as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.plans.registry import table

AS_OF = datetime(2024, 1, 31)
RUN_0 = datetime(1998, 1, 1)
RUN_1 = datetime(2002, 1, 1)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

# --- change feed: events as add and remove actions of a member in a group ---------------

ACTIONS_SQL = """actions AS (
  SELECT user_id AS group_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS member_id,
         CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS action,
         ts, event_id
  FROM events)"""


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("group_id"),
        (key % 10).alias("member_id"),
        F.when(F.col("event_type") == "error", "remove").otherwise("add").alias("action"),
        "ts",
        "event_id",
    )


MEMBERSHIP_SQL = ACTIONS_SQL + """,
seen AS (
  SELECT *, lag(action) OVER (PARTITION BY group_id, member_id ORDER BY event_id) AS prev FROM actions),
changes AS (
  SELECT * FROM seen WHERE (prev IS NULL AND action = 'add') OR (prev IS NOT NULL AND prev <> action)),
timed AS (
  SELECT *, lead(ts) OVER (PARTITION BY group_id, member_id ORDER BY event_id) AS nxt FROM changes),
membership AS (
  SELECT group_id, member_id, ts AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current
  FROM timed WHERE action = 'add')"""

# --- snapshots: order owners before and after a day --------------------------------------

SNAPSHOTS_SQL = """s0 AS (
  SELECT o_custkey AS group_id, o_orderpriority AS owner_id, max(o_orderstatus) AS owner_state
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2),
s1 AS (
  SELECT o_custkey AS group_id, o_orderpriority AS owner_id, max(o_orderstatus) AS owner_state
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2)"""


def owner_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    split = F.lit("1998-01-01").cast("timestamp_ntz")

    def owners(rows: DataFrame) -> DataFrame:
        return rows.groupBy(
            F.col("o_custkey").alias("group_id"), F.col("o_orderpriority").alias("owner_id")
        ).agg(F.max("o_orderstatus").alias("owner_state"))

    return owners(orders.where(F.col("o_orderdate") < split)), owners(orders.where(F.col("o_orderdate") >= split))


# --- nested groups -----------------------------------------------------------------------

GROUPS_SQL = """edges AS (
  SELECT s_suppkey // 3 AS parent, s_suppkey AS child FROM supplier
  UNION
  SELECT s_suppkey, s_suppkey // 9 FROM supplier WHERE s_suppkey % 31 = 0),
members AS (SELECT c_custkey // 15 AS grp, c_custkey AS usr FROM customer)"""

CLOSURE_SQL = GROUPS_SQL + """,
reach AS (
  SELECT parent AS root, child AS grp FROM edges
  UNION
  SELECT r.root, e.child FROM reach r JOIN edges e ON r.grp = e.parent),
closure AS (
  SELECT grp, usr FROM members
  UNION
  SELECT r.root, m.usr FROM reach r JOIN members m ON r.grp = m.grp)"""


def group_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier")
    nested = suppliers.select(F.expr("s_suppkey DIV 3").alias("parent"), key.alias("child"))
    back = suppliers.where(key % 31 == 0).select(key.alias("parent"), F.expr("s_suppkey DIV 9").alias("child"))
    return nested.unionByName(back).distinct()


def group_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.expr("c_custkey DIV 15").alias("grp"), F.col("c_custkey").alias("user")
    )


ROLES_SQL = """roles AS (
  SELECT DISTINCT l_orderkey AS resource_id, l_partkey % 20 AS site_id, o_orderstatus AS resource_type,
         o_orderpriority AS role_definition_id,
         CASE WHEN l_returnflag = 'N' THEN o_custkey ELSE l_suppkey END AS principal_id,
         CASE l_returnflag WHEN 'A' THEN 'SharePointGroup' WHEN 'R' THEN 'SecurityGroup'
              ELSE 'InternalUser' END AS shared_with_type_v2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


#: Lines that one task joins with their orders and makes distinct without spilling.
TASK_LINES = 1_000_000


def role_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments, dealt out by resource; their number, which the files' footers have, gives the number of tasks."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    flag = F.col("l_returnflag")
    tasks = max(lines.count() // TASK_LINES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("resource_id"),
        (F.col("l_partkey") % 20).alias("site_id"),
        F.col("o_orderstatus").alias("resource_type"),
        F.col("o_orderpriority").alias("role_definition_id"),
        F.when(flag == "N", F.col("o_custkey")).otherwise(F.col("l_suppkey")).alias("principal_id"),
        F.when(flag == "A", "SharePointGroup").when(flag == "R", "SecurityGroup").otherwise("InternalUser")
        .alias("shared_with_type_v2"),
    )


ENTITLEMENTS_SQL = CLOSURE_SQL + ",\n" + ROLES_SQL + """,
entitlements AS (
  SELECT site_id, resource_id, resource_type, role_definition_id, usr AS user_object_id, 'SharePointGroup' AS grant_type
  FROM roles JOIN members ON principal_id = grp WHERE shared_with_type_v2 = 'SharePointGroup'
  UNION
  SELECT site_id, resource_id, resource_type, role_definition_id, usr, 'SecurityGroup'
  FROM roles JOIN closure ON principal_id = grp WHERE shared_with_type_v2 = 'SecurityGroup'
  UNION
  SELECT site_id, resource_id, resource_type, role_definition_id, principal_id, 'Direct'
  FROM roles WHERE shared_with_type_v2 IN ('InternalUser', 'B2BUser'))"""

# --- telemetry ---------------------------------------------------------------------------

TELEMETRY_SQL = """telemetry AS (
  SELECT user_id AS gpin, ts AS "timeStamp", event_type AS connection, user_id % 25 AS "workLocationId",
         value AS "latencyAverage",
         CASE p_size % 4 WHEN 0 THEN p_name || ' Jabra' WHEN 1 THEN '' WHEN 2 THEN p_name END AS "teamSpeaker",
         p_size % 6 AS "monitorLayoutCount", p_size * 100 AS "monitorLayoutWidth", p_size * 60 AS "monitorLayoutHeight",
         CASE WHEN p_size % 10 <> 0 THEN p_brand END AS "thisClientBuildVersion",
         CASE WHEN p_size % 11 <> 0 THEN p_type END AS "citrixClientVersion",
         'rh' || (p_partkey % 100) AS "remoteHostName", 'lh' || user_id AS "localHostName",
         CASE p_size % 5
           WHEN 0 THEN 'T2'', ''' || p_brand || ''',''x'
           WHEN 1 THEN p_brand || ',' || p_name
           WHEN 2 THEN 'T1'',''' || p_name
           WHEN 3 THEN p_brand || ''',''' || p_name
         END AS "audioDeviceComposite",
         'gw' || (p_partkey % 7) AS gateway, event_id
  FROM events JOIN part ON p_partkey = event_id // 5)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, part = table(spark, sf_dir, "events"), table(spark, sf_dir, "part")
    size, brand, name = F.col("p_size"), F.col("p_brand"), F.col("p_name")
    joined = events.join(part, F.expr("event_id DIV 5") == F.col("p_partkey"))
    return joined.select(
        F.col("user_id").alias("gpin"),
        F.col("ts").alias("timeStamp"),
        F.col("event_type").alias("connection"),
        (F.col("user_id") % 25).alias("workLocationId"),
        F.col("value").alias("latencyAverage"),
        F.when(size % 4 == 0, F.concat(name, F.lit(" Jabra"))).when(size % 4 == 1, "")
        .when(size % 4 == 2, name).alias("teamSpeaker"),
        (size % 6).alias("monitorLayoutCount"),
        (size * 100).alias("monitorLayoutWidth"),
        (size * 60).alias("monitorLayoutHeight"),
        F.when(size % 10 != 0, brand).alias("thisClientBuildVersion"),
        F.when(size % 11 != 0, F.col("p_type")).alias("citrixClientVersion"),
        F.concat(F.lit("rh"), F.col("p_partkey") % 100).alias("remoteHostName"),
        F.concat(F.lit("lh"), F.col("user_id")).alias("localHostName"),
        F.when(size % 5 == 0, F.concat(F.lit("T2', '"), brand, F.lit("','x")))
        .when(size % 5 == 1, F.concat_ws(",", brand, name))
        .when(size % 5 == 2, F.concat(F.lit("T1','"), name))
        .when(size % 5 == 3, F.concat_ws("','", brand, name)).alias("audioDeviceComposite"),
        F.concat(F.lit("gw"), F.col("p_partkey") % 7).alias("gateway"),
        "event_id",
    )


LOOKUP_SQL = """lookup AS (
  SELECT 'rh' || (s_suppkey % 100) AS host, 'gw' || (s_suppkey % 7) AS gw,
         max('Brand#' || (s_suppkey % 25 + 1)) AS build
  FROM supplier GROUP BY 1, 2)"""


def build_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").groupBy(
        F.concat(F.lit("rh"), key % 100).alias("HostName"), F.concat(F.lit("gw"), key % 7).alias("Gateway")
    ).agg(F.max(F.concat(F.lit("Brand#"), key % 25 + 1)).alias("buildVersion"))


PEOPLE_SQL = """people AS (
  SELECT DISTINCT c_custkey AS gpin
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'AMERICA' AND c_acctbal >= -900 AND n_name NOT LIKE '%NATION_11%')"""


def people_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    status = F.when(F.col("c_acctbal") >= -900, "Active").otherwise("Left")
    return {
        "people": customer.select(
            F.col("c_custkey").alias("gpin"), F.col("c_custkey").alias("HriEmployeeId"),
            F.col("c_nationkey").alias("workLocationId"),
        ),
        "employees": customer.select(
            F.col("c_custkey").alias("Id"), F.col("c_nationkey").alias("OrganizationalUnitId"), status.alias("Status")
        ),
        "units": nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("Id"), F.col("r_name").alias("Division"), F.col("r_name").alias("Country")
        ),
        "locations": nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("locationName")),
    }


CLIENTS_SQL = """valid_builds AS (
  SELECT p_brand AS build FROM part WHERE p_brand IS NOT NULL
  GROUP BY p_brand ORDER BY count(DISTINCT p_name) DESC, p_brand LIMIT 2)"""


def thin_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("BuildVersion"), F.col("p_name").alias("EMMA"))


SUPPORTED_SQL = """supported AS (SELECT DISTINCT p_type AS val FROM part WHERE p_type NOT LIKE 'S%')"""


def supported_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").where(~F.col("p_type").like("S%"))
    return types.select(F.col("p_type").alias("Value")).distinct()
