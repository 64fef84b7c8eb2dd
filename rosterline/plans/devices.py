"""Queries over device telemetry: populations, limits, issue rules and reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.functions.columns import recency_label
from rosterline.functions.predicates import none_like, within
from rosterline.operators import keyed, telemetry as T
from rosterline.plans import inputs
from rosterline.plans.registry import query, table
from rosterline.workspace import fresh_dir, sized


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.eligible_people(
        **inputs.people_tables(spark, sf_dir), status="Active", division="AMERICA", country="AMERICA",
        excluded_locations=["%NATION_11%"],
    )


@query(f"WITH {inputs.PEOPLE_SQL} SELECT gpin FROM people")
def population_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir)


@query(f"""
WITH {inputs.PEOPLE_SQL}
SELECT event_id, user_id AS gpin, ts, value FROM events
WHERE user_id IN (SELECT gpin FROM people) AND ts >= {inputs.AS_OF_SQL} - INTERVAL 7 DAY
""")
def semi_join_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("gpin"), "ts", "value")
    recent = events.where(within(F.col("ts"), inputs.AS_OF, "7 days"))
    return T.of_people(recent, sized(_people(spark, sf_dir), "people"))


LATENCY_EVENTS = """SELECT user_id % 25 AS place, event_type AS connection, value FROM events"""


def _latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 25).alias("workLocationId"), F.col("event_type").alias("connection"),
        F.col("value").alias("latencyAverage"),
    )


@query("""
WITH limits AS (
  SELECT user_id % 25 AS place, event_type AS conn, quantile_disc(value, 0.75) AS p75 FROM events GROUP BY 1, 2)
SELECT event_id, user_id % 25 AS "workLocationId", event_type AS connection, value AS "latencyAverage",
       p75 AS "latencyThreshold"
FROM events LEFT JOIN limits ON user_id % 25 = place AND event_type = conn
""")
def threshold_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latency(spark, sf_dir)
    return T.with_limits(rows, T.percentile_limits(rows)).select(*rows.columns, "latencyThreshold")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(CASE WHEN p_size <> 1 THEN p_brand END, s_name, 'unknown') AS label
FROM lineitem
LEFT JOIN (SELECT p_partkey, p_size, p_brand FROM part WHERE p_size <= 40) ON l_partkey = p_partkey
LEFT JOIN (SELECT s_suppkey, s_nationkey, s_name FROM supplier WHERE s_acctbal > 0)
       ON l_suppkey = s_suppkey AND l_linenumber = s_nationkey % 7 + 1
""")
def lookup_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").where("p_size <= 40").select("p_partkey", "p_size", "p_brand")
    supplier = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(
        "s_suppkey", (F.col("s_nationkey") % 7 + 1).alias("s_line"), "s_name"
    )
    first = F.when(F.col("p_size") != 1, F.col("p_brand"))
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("l_linenumber") == F.col("s_line")), "left")
        .select(*lines.columns, F.coalesce(first, "s_name", F.lit("unknown")).alias("label"))
    )


@query(f"""
WITH {inputs.CLIENTS_SQL}
SELECT p_partkey, p_brand FROM part
WHERE p_brand IS NOT NULL AND p_brand NOT IN (SELECT build FROM valid_builds)
""")
def not_in_valid_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    valid = T.valid_builds(inputs.thin_clients(spark, sf_dir))
    flagged = T.flag_listed(parts, F.trim("p_brand"), valid, "build", "ok")
    return flagged.where(~F.col("ok")).select("p_partkey", "p_brand")


@query("""
SELECT p_brand AS "BuildVersion", count(DISTINCT p_name) AS events FROM part WHERE p_brand IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2
""")
def count_distinct_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.top_by_distinct(inputs.thin_clients(spark, sf_dir), "BuildVersion", "EMMA", T.VALID_BUILDS)


@query(f"""
SELECT place AS "workLocationId", connection, quantile_disc(value, 0.75) AS "latencyThreshold"
FROM ({LATENCY_EVENTS}) GROUP BY 1, 2
""")
def percentile_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.percentile_limits(_latency(spark, sf_dir))


FENCE_SQL = f"""fences AS (
  SELECT place, connection AS conn, q1, q3, q3 + 1.5 * (q3 - q1) AS bound FROM (
    SELECT place, connection, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
    FROM ({LATENCY_EVENTS}) GROUP BY 1, 2))"""


@query(f"""
WITH {FENCE_SQL}
SELECT place AS "workLocationId", conn AS connection, q1, q3, bound AS "latencyUpperBound" FROM fences
""")
def iqr_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.fence_limits(_latency(spark, sf_dir))


@query("""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return keyed.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query("""
SELECT p_partkey, p_name, p_brand FROM part
WHERE p_name NOT LIKE '%ring%' AND p_name NOT LIKE 'old%' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
""")
def not_like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return parts.where(none_like(F.col("p_name"), ["%ring%", "old%"]) & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))


# --- single issue rules, over all people -------------------------------------------------

HEAD_SQL = 'gpin, "timeStamp", connection, "remoteHostName", "localHostName"'
FORMS_SQL = """'{name}' AS "issueType", CAST({metric} AS VARCHAR) AS metric"""


def _issue(name: str, metric: str, source: str, condition: str, extra: str = "") -> str:
    return f"""
WITH {inputs.TELEMETRY_SQL}{extra}
SELECT {HEAD_SQL}, {FORMS_SQL.format(name=name, metric=metric)} FROM {source} WHERE {condition}
"""


P75_SQL = """,
limits AS (
  SELECT "workLocationId" AS place, connection AS conn, quantile_disc("latencyAverage", 0.75) AS bound
  FROM telemetry GROUP BY 1, 2)"""
IQR_SQL = """,
quartiles AS (
  SELECT "workLocationId" AS place, connection AS conn, quantile_disc("latencyAverage", 0.25) AS q1,
         quantile_disc("latencyAverage", 0.75) AS q3
  FROM telemetry GROUP BY 1, 2),
limits AS (SELECT place, conn, q3 + 1.5 * (q3 - q1) AS bound FROM quartiles)"""
WITH_LIMITS = 'telemetry LEFT JOIN limits ON "workLocationId" = place AND connection = conn'


@query(_issue(T.LATENCY, '"latencyAverage"', WITH_LIMITS, '"latencyAverage" > bound', P75_SQL))
def issue_latency_p75(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.telemetry(spark, sf_dir)
    judged = T.with_limits(rows, T.percentile_limits(rows))
    return T.apply_rules(judged, [T.Rule(T.LATENCY, F.col("latencyAverage"), F.expr("latencyAverage > latencyThreshold"))])


@query(_issue(T.LATENCY, '"latencyAverage"', WITH_LIMITS, '"latencyAverage" > bound', IQR_SQL))
def issue_latency_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.telemetry(spark, sf_dir)
    judged = T.with_limits(rows, T.fence_limits(rows))
    return T.apply_rules(judged, [T.Rule(T.LATENCY, F.col("latencyAverage"), F.expr("latencyAverage > latencyUpperBound"))])


SPEAKER_V2_SQL = "\"teamSpeaker\" <> '' AND " + " AND ".join(
    f"\"teamSpeaker\" NOT LIKE '%{vendor}%'" for vendor in T.KNOWN_SPEAKERS
)
DISPLAY_V1_SQL = ('"monitorLayoutCount" NOT IN (1, 2, 3) OR '
                  '"monitorLayoutWidth" * "monitorLayoutHeight" > 7864320')
DISPLAY_V2_SQL = ('"monitorLayoutWidth" * "monitorLayoutHeight" > 921600 OR "monitorLayoutWidth" > 3840 '
                  'OR "monitorLayoutHeight" > 2160')
DISPLAY_V1_METRIC = '"monitorLayoutWidth" || \' x \' || "monitorLayoutHeight"'
DISPLAY_V2_METRIC = '"monitorLayoutCount" || \' x \' || ' + DISPLAY_V1_METRIC


@query(_issue(T.SPEAKER, '"teamSpeaker"', "telemetry", SPEAKER_V2_SQL))
def issue_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.col("teamSpeaker")
    return T.apply_rules(inputs.telemetry(spark, sf_dir), [T.Rule(T.SPEAKER, speaker, T.speaker_condition(speaker, 2))])


@query(f"""
WITH {inputs.TELEMETRY_SQL}
SELECT {HEAD_SQL}, 'Visual Display Setup' AS "issueType", {DISPLAY_V1_METRIC} AS metric FROM telemetry WHERE {DISPLAY_V1_SQL}
UNION ALL
SELECT {HEAD_SQL}, 'Visual Display Setup', {DISPLAY_V2_METRIC} FROM telemetry WHERE {DISPLAY_V2_SQL}
""")
def issue_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.apply_rules(inputs.telemetry(spark, sf_dir), [T.display_rule(1), T.display_rule(2)])


@query(_issue(T.BUILD, '"thisClientBuildVersion"', "telemetry",
              '"thisClientBuildVersion" IS NOT NULL AND '
              '"thisClientBuildVersion" NOT IN (SELECT build FROM valid_builds)', ",\n" + inputs.CLIENTS_SQL))
def issue_build_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = F.col("thisClientBuildVersion")
    valid = T.valid_builds(inputs.thin_clients(spark, sf_dir))
    flagged = T.flag_listed(inputs.telemetry(spark, sf_dir), build, valid, "build", "ok")
    return T.apply_rules(flagged, [T.Rule(T.BUILD, build, ~F.col("ok"))])


@query(_issue(T.CLIENT, '"citrixClientVersion"', "telemetry",
              '"citrixClientVersion" IS NOT NULL AND '
              'trim("citrixClientVersion") NOT IN (SELECT val FROM supported)', ",\n" + inputs.SUPPORTED_SQL))
def issue_client_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    supported = inputs.supported_values(spark, sf_dir)
    flagged = T.flag_listed(inputs.telemetry(spark, sf_dir), F.trim("citrixClientVersion"), supported, "Value", "ok")
    return T.apply_rules(flagged, [T.Rule(T.CLIENT, F.col("citrixClientVersion"), ~F.col("ok"))])


# The first part of the text, cut at the quoted comma if there is one, else at the plain one, less its layout's
# prefix. No build in an empty device; an empty build in a text without any comma.
QUOTED_SQL = """contains("audioDeviceComposite", ''',''')"""
FIRST_SQL = f"""split_part("audioDeviceComposite", CASE WHEN {QUOTED_SQL} THEN ''',''' ELSE ',' END, 1)"""
BUILD_SQL = f"""CASE WHEN {FIRST_SQL} = 'T1' THEN NULL WHEN NOT contains("audioDeviceComposite", ',') THEN ''
    ELSE replace({FIRST_SQL}, CASE WHEN {QUOTED_SQL} THEN 'T2'', ''' ELSE 'T1'', ''' END, '') END"""


@query(f"""
WITH {inputs.TELEMETRY_SQL},
{inputs.LOOKUP_SQL}
SELECT event_id, {BUILD_SQL} AS parsed, coalesce({BUILD_SQL}, build) AS "finalClientBuildVersion"
FROM telemetry LEFT JOIN lookup ON "remoteHostName" = host AND gateway = gw
""")
def composite_version_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_build(inputs.telemetry(spark, sf_dir), inputs.build_lookup(spark, sf_dir)).select(
        "event_id", F.col("thisClientBuildVersion").alias("parsed"), "finalClientBuildVersion"
    )


PERIOD_SQL = f"""CASE WHEN "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 1 DAY THEN 'Last 24 hours'
       WHEN "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 3 DAY THEN 'Last 3 days'
       WHEN "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 7 DAY THEN 'Last 7 days'
       ELSE 'Last 30 days' END"""


@query(f"""
SELECT event_id, "timeStamp", {PERIOD_SQL} AS "timePeriod"
FROM (SELECT event_id, ts AS "timeStamp" FROM events)
WHERE "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 30 DAY
""")
def recency_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timeStamp"))
    recent = events.where(within(F.col("timeStamp"), inputs.AS_OF, "30 days"))
    return recent.withColumn("timePeriod", recency_label(F.col("timeStamp"), inputs.AS_OF))


# --- reports -----------------------------------------------------------------------------


def _branch(name: str, metric: str, condition: str) -> str:
    return (f'SELECT {HEAD_SQL}, \'{name}\' AS "issueType", CAST({metric} AS VARCHAR) AS metric, '
            f'{PERIOD_SQL} AS "timePeriod" FROM judged WHERE {condition}')


REPORT_V1_SQL = f"""
WITH {inputs.TELEMETRY_SQL},
{inputs.PEOPLE_SQL},
{inputs.CLIENTS_SQL},
{inputs.SUPPORTED_SQL},
mine AS (SELECT * FROM telemetry WHERE gpin IN (SELECT gpin FROM people)),
limits AS (
  SELECT "workLocationId" AS place, connection AS conn, quantile_disc("latencyAverage", 0.75) AS bound
  FROM mine GROUP BY 1, 2),
newest AS (
  SELECT *, row_number() OVER (PARTITION BY gpin, connection ORDER BY "timeStamp" DESC) AS rn
  FROM mine WHERE "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 30 DAY),
judged AS (
  SELECT * FROM newest LEFT JOIN limits ON "workLocationId" = place AND connection = conn WHERE rn = 1)
""" + "\nUNION ALL\n".join([
    _branch(T.LATENCY, '"latencyAverage"', '"latencyAverage" > bound'),
    _branch(T.SPEAKER, '"teamSpeaker"', '"teamSpeaker" <> \'\''),
    _branch(T.DISPLAY, DISPLAY_V1_METRIC, DISPLAY_V1_SQL),
    _branch(T.BUILD, '"thisClientBuildVersion"', '"thisClientBuildVersion" NOT IN (SELECT build FROM valid_builds)'),
    _branch(T.CLIENT, '"citrixClientVersion"', '"citrixClientVersion" NOT IN (SELECT val FROM supported)'),
])

REPORT_V2_SQL = f"""
WITH {inputs.TELEMETRY_SQL},
{inputs.PEOPLE_SQL},
{inputs.CLIENTS_SQL},
{inputs.SUPPORTED_SQL},
{inputs.LOOKUP_SQL},
mine AS (
  SELECT * FROM telemetry
  WHERE gpin IN (SELECT gpin FROM people) AND "timeStamp" >= {inputs.AS_OF_SQL} - INTERVAL 30 DAY),
limits AS (
  SELECT place, conn, q3 + 1.5 * (q3 - q1) AS bound FROM (
    SELECT "workLocationId" AS place, connection AS conn, quantile_disc("latencyAverage", 0.25) AS q1,
           quantile_disc("latencyAverage", 0.75) AS q3
    FROM mine GROUP BY 1, 2)),
judged AS (
  SELECT *, coalesce({BUILD_SQL}, build) AS final_build
  FROM mine LEFT JOIN lookup ON "remoteHostName" = host AND gateway = gw
  LEFT JOIN limits ON "workLocationId" = place AND connection = conn)
""" + "\nUNION ALL\n".join([
    _branch(T.LATENCY, '"latencyAverage"', '"latencyAverage" > bound'),
    _branch(T.SPEAKER, '"teamSpeaker"', SPEAKER_V2_SQL),
    _branch(T.DISPLAY, DISPLAY_V2_METRIC, DISPLAY_V2_SQL),
    _branch(T.BUILD, "final_build", "final_build NOT IN (SELECT build FROM valid_builds)"),
    _branch(T.CLIENT, '"citrixClientVersion"', 'trim("citrixClientVersion") NOT IN (SELECT val FROM supported)'),
])


@query(REPORT_V1_SQL)
def issue_report_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.issue_report_v1(
        inputs.telemetry(spark, sf_dir), _people(spark, sf_dir), inputs.thin_clients(spark, sf_dir),
        inputs.supported_values(spark, sf_dir), inputs.AS_OF,
    )


@query(REPORT_V2_SQL)
def issue_report_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.issue_report_v2(
        inputs.telemetry(spark, sf_dir), _people(spark, sf_dir), inputs.thin_clients(spark, sf_dir),
        inputs.supported_values(spark, sf_dir), inputs.build_lookup(spark, sf_dir), inputs.AS_OF,
    )


@query(REPORT_V2_SQL)
def issue_report_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second report with limits from stored counts of days, the last days of which were added later."""
    rows, people = inputs.telemetry(spark, sf_dir), sized(_people(spark, sf_dir), "people")
    mine = T.of_people(rows, people)
    kept = T.DailyCounts(
        spark, fresh_dir(spark, "daily-counts"), "`workLocationId` BIGINT, connection STRING, `latencyAverage` DOUBLE"
    )
    middle = F.lit("2024-01-20").cast("timestamp_ntz")
    kept.add(mine.where(F.col("timeStamp") < middle))
    kept.add(mine.where(F.col("timeStamp") >= middle))
    first = (inputs.AS_OF - timedelta(days=30)).date()
    return T.issue_report_v2(
        rows, people, inputs.thin_clients(spark, sf_dir), inputs.supported_values(spark, sf_dir),
        inputs.build_lookup(spark, sf_dir), inputs.AS_OF, T.fence_of_counts(kept.counts(first)),
    )
