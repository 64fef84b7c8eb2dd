"""Device telemetry: eligible people, latency limits, issue rules and the issue reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rosterline.functions.columns import build_version, recency_label
from rosterline.functions.predicates import none_like, within
from rosterline.operators.keyed import latest_per_key, top_by_distinct
from rosterline.sinks.tables import replace_partitions
from rosterline.workspace import sized, stored

# Issue names, vendor texts that make a speaker unremarkable, display limits.
LATENCY = "Citrix ICA Latency"
SPEAKER = "Teams Speaker Setup"
DISPLAY = "Visual Display Setup"
BUILD = "Thin Client Build Version"
CLIENT = "Citrix Client Version"
KNOWN_SPEAKERS = (
    "VDI Optimized", "Jabra", "Plantronics", "Logitech", "Sennheiser", "Poly", "Nureva", "Huddly",
    "Bose", "Crestron", "Yealink", "EPOS", "HP", "Lenovo", "Dell", "Microsoft",
)
USUAL_MONITOR_COUNTS = (1, 2, 3)
MAX_PIXELS_V1 = 7864320
MAX_PIXELS_V2 = 921600
MAX_WIDTH = 3840
MAX_HEIGHT = 2160
FENCE_FACTOR = 1.5
REPORT_DAYS = "30 days"
VALID_BUILDS = 2

#: So many different values a task can put in order.
ORDERED_VALUES = 5_000_000
REPORT_COLUMNS = ["gpin", "timeStamp", "connection", "remoteHostName", "localHostName", "issueType", "metric"]

PLACE = ["workLocationId", "connection"]


@dataclass(frozen=True)
class Rule:
    """One issue: a name, the value to report and the condition that raises it."""

    name: str
    metric: Column
    condition: Column


def eligible_people(
    people: DataFrame, employees: DataFrame, units: DataFrame, locations: DataFrame,
    status: str, division: str, country: str, excluded_locations: list[str],
) -> DataFrame:
    """Distinct ``gpin`` of active people in one division and country at a real workplace."""
    staff = employees.where(F.col("Status") == status).select(
        F.col("Id").alias("HriEmployeeId"), "OrganizationalUnitId"
    )
    chosen_units = units.where((F.col("Division") == division) & (F.col("Country") == country)).select(
        F.col("Id").alias("OrganizationalUnitId")
    )
    places = locations
    if excluded_locations:
        places = places.where(none_like(F.col("locationName"), excluded_locations))
    places = places.select(F.col("Id").alias("workLocationId"))
    return (
        people.select("gpin", "HriEmployeeId", "workLocationId")
        .join(staff, "HriEmployeeId")
        .join(chosen_units, "OrganizationalUnitId")
        .join(places, "workLocationId")
        .select("gpin")
        .distinct()
    )


def value_counts(telemetry: DataFrame, measure: str, keys: list[str]) -> DataFrame:
    """(keys, measure, n): how often each value occurs in each group; a NULL value counts 0."""
    return telemetry.groupBy(*keys, measure).agg(F.count(measure).alias("n"))


def _ranks(total: Column, shares: dict[str, float]) -> dict[str, Column]:
    # Decimals, as a product of doubles could round past a whole rank.
    rank = {name: F.ceil(total.cast("decimal(18,0)") * F.lit(Decimal(str(share)))) for name, share in shares.items()}
    return {name: F.greatest(r.cast("bigint"), F.lit(1)) for name, r in rank.items()}


def _holds(upto: Column, n: Column, rank: Column) -> Column:
    return (upto - n < rank) & (upto >= rank)


def exact_quantiles(telemetry: DataFrame, measure: str, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Per group, for each name in ``shares`` the value whose rank is that share of the rows, rounded up.

    NULL values do not count; a group of NULLs only has NULL limits.
    """
    return quantiles_of_counts(value_counts(telemetry, measure, keys), measure, keys, shares)


def quantiles_of_counts(
    counts: DataFrame, measure: str, keys: list[str], shares: dict[str, float], ordered_values: int = ORDERED_VALUES
) -> DataFrame:
    """The same from counts (:func:`value_counts`); counts of several days may simply be put together.

    Different values are stored once, which also tells how many there are. Up to
    ``ordered_values``, which one task can order even if they are all of one group, a running sum per group
    finds the ranks. More are cut in ranges first, and only ranges that hold a rank are put in order.
    """
    counts = counts.groupBy(*keys, measure).agg(F.sum("n").alias("__n"))
    counts, values = stored(counts, "value-counts", F.count(F.lit(1)))
    if values > ordered_values:
        return _ranged_quantiles(counts, measure, keys, shares)
    group = Window.partitionBy(*keys)
    summed = counts.withColumn("__upto", F.sum("__n").over(group.orderBy(F.col(measure).asc_nulls_first())))
    summed = summed.withColumn("__all", F.sum("__n").over(group))
    found = [
        F.max(F.when(_holds(F.col("__upto"), F.col("__n"), r), F.col(measure))).alias(name)
        for name, r in _ranks(F.col("__all"), shares).items()
    ]
    return summed.groupBy(*keys).agg(*found)


def _ranged_quantiles(counts: DataFrame, measure: str, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Groups and values are cut in ranges, a running sum over the ranges of a group finds those that
    hold a rank, and only these are put in order, each in a task of its own."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, *keys, measure).withColumn("__range", F.spark_partition_id())
    ranged = sized(ranged, "value-ranges")

    group = Window.partitionBy(*keys)
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__in"))  # a group has a row for each range at most
    sums = sums.withColumn("__upto", F.sum("__in").over(group.orderBy("__range"))).withColumn("__all", F.sum("__in").over(group))
    rank = _ranks(F.col("__all"), shares)
    wanted = reduce(lambda c, r: c | _holds(F.col("__upto"), F.col("__in"), r), rank.values(), F.col("__all") == 0)
    before = (F.col("__upto") - F.col("__in")).alias("__before")
    marked = sized(
        sums.where(wanted).select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col("__range").alias("__at"), before, "__all"), "rank-ranges"
    )
    same = reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"__key_{k}")), keys, F.col("__range") == F.col("__at"))
    inside = Window.partitionBy(*keys, "__range").orderBy(measure)
    rows = ranged.join(marked, same).withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
    found = [F.max(F.when(_holds(F.col("__upto"), F.col("__n"), r), F.col(measure))).alias(name) for name, r in rank.items()]
    return rows.groupBy(*keys).agg(*found)


def percentile_limits(telemetry: DataFrame, measure: str = "latencyAverage", keys: list[str] = PLACE,
                      share: float = 0.75, name: str = "latencyThreshold") -> DataFrame:
    """The exact ``share`` percentile of a measure per group."""
    return exact_quantiles(telemetry, measure, keys, {name: share})


def fence_limits(telemetry: DataFrame, measure: str = "latencyAverage", keys: list[str] = PLACE,
                 name: str = "latencyUpperBound") -> DataFrame:
    """Upper interquartile fence per group, with the exact quartiles."""
    return fence_of_counts(value_counts(telemetry, measure, keys), measure, keys, name)


def fence_of_counts(counts: DataFrame, measure: str = "latencyAverage", keys: list[str] = PLACE,
                    name: str = "latencyUpperBound") -> DataFrame:
    """The same from counts of values, for example those that :class:`DailyCounts` keeps."""
    quartiles = quantiles_of_counts(counts, measure, keys, {"q1": 0.25, "q3": 0.75})
    q1, q3 = F.col("q1"), F.col("q3")
    return quartiles.select(*keys, q1, q3, (q3 + FENCE_FACTOR * (q3 - q1)).alias(name))


class DailyCounts:
    """Value counts of a measure per group and day: a new day adds its own counts, no day is counted again.

    The counts of any span of days add up to exact limits of all its rows. A day that is
    counted again replaces its counts. Which rows count (of which people, say) is decided
    on the day they are counted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, measure: str = "latencyAverage", keys: list[str] = PLACE) -> None:
        self.spark, self.path, self.measure, self.keys = spark, path, measure, keys
        self.schema = f"{schema}, n BIGINT, day DATE"

    def add(self, telemetry: DataFrame, ts: str = "timeStamp") -> None:
        """Counts all days that occur in ``telemetry``, each of them whole."""
        dated = telemetry.withColumn("day", F.to_date(ts))
        counts = value_counts(dated, self.measure, ["day", *self.keys])
        replace_partitions(counts.where(F.col("day").isNotNull()), self.path, ["day"])

    def counts(self, first: date, last: date | None = None) -> DataFrame:
        """The counts of the days from ``first`` (to ``last``); other days' files are not read."""
        rows = self.spark.read.schema(self.schema).parquet(self.path).where(F.col("day") >= F.lit(first))
        return (rows if last is None else rows.where(F.col("day") <= F.lit(last))).drop("day")


def with_limits(telemetry: DataFrame, limits: DataFrame, keys: list[str] = PLACE) -> DataFrame:
    """Adds the limits of each row's group; the rows are not shuffled while limits are few."""
    return telemetry.join(sized(limits, "limits"), keys, "left")


def of_people(telemetry: DataFrame, people: DataFrame, key: str = "gpin") -> DataFrame:
    """Rows of the given people."""
    return telemetry.join(people.select(key), key, "left_semi")


def valid_builds(clients: DataFrame, version: str = "BuildVersion", device: str = "EMMA") -> DataFrame:
    """The two builds most devices run."""
    return top_by_distinct(clients, version, device, VALID_BUILDS).select(F.col(version).alias("build"))


def flag_listed(df: DataFrame, value: Column, listed: DataFrame, column: str, flag: str) -> DataFrame:
    """Adds whether ``value`` occurs in a list table; NULL in the list is ignored, a NULL value gives NULL."""
    known = sized(listed.where(F.col(column).isNotNull()).select(F.col(column).alias("__listed")).distinct(), "listed")
    joined = df.withColumn("__value", value).join(
        known.withColumn("__hit", F.lit(True)), F.col("__value") == F.col("__listed"), "left"
    )
    found = F.when(F.col("__value").isNotNull(), F.coalesce("__hit", F.lit(False)))
    return joined.withColumn(flag, found).drop("__value", "__listed", "__hit")


def speaker_condition(text: Column, version: int) -> Column:
    """v1: any speaker text; v2: a speaker text that names no known vendor."""
    present = text.isNotNull() & (text != "")
    if version == 1:
        return present
    return reduce(lambda condition, vendor: condition & ~text.contains(vendor), KNOWN_SPEAKERS, present)


def display_rule(version: int) -> Rule:
    """v1: unusual monitor count or very many pixels; v2: many pixels or a large side."""
    count, width, height = (F.col(f"monitorLayout{side}") for side in ("Count", "Width", "Height"))
    pixels = width.cast("bigint") * height
    if version == 1:
        condition = ~count.isin(*USUAL_MONITOR_COUNTS) | (pixels > MAX_PIXELS_V1)
        return Rule(DISPLAY, F.concat_ws(" x ", width, height), condition)
    condition = (pixels > MAX_PIXELS_V2) | (width > MAX_WIDTH) | (height > MAX_HEIGHT)
    return Rule(DISPLAY, F.concat_ws(" x ", count, width, height), condition)


def apply_rules(telemetry: DataFrame, rules: list[Rule]) -> DataFrame:
    """One report row per raised issue. All rules are tested in one pass over the rows."""
    raised = F.array(
        *[
            F.when(
                rule.condition,
                F.struct(F.lit(rule.name).alias("issueType"), rule.metric.cast("string").alias("metric")),
            )
            for rule in rules
        ]
    )
    head = [c for c in REPORT_COLUMNS if c not in ("issueType", "metric")]
    return telemetry.select(*head, F.inline(F.array_compact(raised)))


def with_build(telemetry: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``finalClientBuildVersion``: parsed from the composite text, else looked up by host and gateway.

    A host and gateway that the lookup holds several times counts once, with its greatest build.
    """
    known = lookup.groupBy(F.col("HostName").alias("__host"), F.col("Gateway").alias("__gateway")).agg(
        F.max("buildVersion").alias("__build")
    )
    on_host = (F.col("remoteHostName") == F.col("__host")) & (F.col("gateway") == F.col("__gateway"))
    parsed = telemetry.withColumn("thisClientBuildVersion", build_version(F.col("audioDeviceComposite")))
    return (
        parsed.join(known, on_host, "left")
        .withColumn("finalClientBuildVersion", F.coalesce("thisClientBuildVersion", "__build"))
        .drop("__host", "__gateway", "__build")
    )


def issue_report_v1(
    telemetry: DataFrame, people: DataFrame, clients: DataFrame, approved: DataFrame, as_of: datetime
) -> DataFrame:
    """Issues on the newest row per person and connection of the last 30 days.

    Latency is held against the 75th percentile of all times. ``clients`` has (BuildVersion,
    EMMA), ``approved`` has (Value). Of rows of a person and connection at one time the one
    whose other columns compare greatest counts.
    """
    rows = of_people(telemetry, sized(people, "people"))
    order = ["timeStamp", *(c for c in sorted(rows.columns) if c not in ("gpin", "connection", "timeStamp"))]
    newest = latest_per_key(rows.where(within(F.col("timeStamp"), as_of, REPORT_DAYS)), ["gpin", "connection"], order)
    judged = with_limits(newest, percentile_limits(rows))
    judged = flag_listed(judged, F.col("thisClientBuildVersion"), valid_builds(clients), "build", "__build_ok")
    judged = flag_listed(judged, F.col("citrixClientVersion"), approved, "Value", "__client_ok")
    rules = [
        Rule(LATENCY, F.col("latencyAverage"), F.col("latencyAverage") > F.col("latencyThreshold")),
        Rule(SPEAKER, F.col("teamSpeaker"), speaker_condition(F.col("teamSpeaker"), 1)),
        display_rule(1),
        Rule(BUILD, F.col("thisClientBuildVersion"), ~F.col("__build_ok")),
        Rule(CLIENT, F.col("citrixClientVersion"), ~F.col("__client_ok")),
    ]
    return apply_rules(judged, rules).withColumn("timePeriod", recency_label(F.col("timeStamp"), as_of))


def issue_report_v2(
    telemetry: DataFrame, people: DataFrame, clients: DataFrame, supported: DataFrame, lookup: DataFrame,
    as_of: datetime, limits: DataFrame | None = None,
) -> DataFrame:
    """Issues on every row of the last 30 days, latency held against the interquartile fence.

    ``limits`` of these rows may be given, for example from :class:`DailyCounts`.
    """
    recent = of_people(telemetry.where(within(F.col("timeStamp"), as_of, REPORT_DAYS)), sized(people, "people"))
    limits = (fence_limits(recent) if limits is None else limits).select(*PLACE, "latencyUpperBound")
    judged = with_limits(with_build(recent, lookup), limits)
    judged = flag_listed(judged, F.col("finalClientBuildVersion"), valid_builds(clients), "build", "__build_ok")
    judged = flag_listed(judged, F.trim("citrixClientVersion"), supported, "Value", "__client_ok")
    rules = [
        Rule(LATENCY, F.col("latencyAverage"), F.col("latencyAverage") > F.col("latencyUpperBound")),
        Rule(SPEAKER, F.col("teamSpeaker"), speaker_condition(F.col("teamSpeaker"), 2)),
        display_rule(2),
        Rule(BUILD, F.col("finalClientBuildVersion"), ~F.col("__build_ok")),
        Rule(CLIENT, F.col("citrixClientVersion"), ~F.col("__client_ok")),
    ]
    return apply_rules(judged, rules).withColumn("timePeriod", recency_label(F.col("timeStamp"), as_of))
