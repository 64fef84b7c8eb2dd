"""Temporal URL lists: which captures were on a list when they were fetched.

Dated entries (a domain is added to or removed from a category) become validity intervals;
an as-of join meets every capture with the intervals of its host's domains that hold at the
time of the fetch. A domain covers its subdomains. Intervals are cut in time bins, so a
domain with a long history offers a capture only the intervals of its own bin; captures
stand on the left of the join, where the adaptive planner can split a hot host.

Defined cases: an interval begins with its entry and ends before the removal; of entries
of a domain and category at one time a removal wins; adding what is listed and removing
what is not do nothing; NULL domains, categories and times in entries are ignored; captures
with no host, or no time, are on no list; equal captures (same id, URL and time) are one
row; empty tables are allowed; other columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BIN_DAYS = 30
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host(url: Column) -> Column:
    """The host of an absolute URL in lower case; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(url)), _HOST, 1), F.lit(""))


def domains(name: Column) -> Column:
    """A host and its parent domains of at least two labels."""
    labels = F.filter(F.split(name, r"\."), lambda x: x != "")
    return F.transform(
        F.when(F.size(labels) > 1, F.sequence(F.lit(1), F.size(labels) - 1)).otherwise(F.array(F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def validity(entries: DataFrame, domain: str = "domain", category: str = "category", action: str = "action", at: str = "at") -> DataFrame:
    """Intervals (``domain``, ``category``, ``valid_from``, ``valid_to``; open ends NULL) from dated entries.

    The last action per domain, category and time counts; runs of equal actions count once.
    """
    key = ["domain", "category"]
    days = entries.select(
        F.lower(F.col(domain)).alias("domain"), F.col(category).alias("category"), F.col(at).alias("at"),
        (F.col(action) == "add").cast("int").alias("listed"),
    ).dropna().groupBy(*key, "at").agg(F.min("listed").alias("listed"))
    order = Window.partitionBy(*key).orderBy("at")
    turns = days.withColumn("before", F.coalesce(F.lag("listed").over(order), F.lit(0))).where("listed <> before")
    turns = turns.withColumn("valid_to", F.lead("at").over(order))
    return turns.where("listed = 1").select(*key, F.col("at").alias("valid_from"), "valid_to")


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(F.to_date(day)) / BIN_DAYS)


def filter_captures(
    captures: DataFrame, intervals: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched_at"
) -> DataFrame:
    """Rows (``id_col``, ``url_col``, ``at_col``, ``host``, ``categories`` sorted, ``blocked``)."""
    keys = [id_col, url_col, at_col]
    span = captures.agg(F.min(at_col).alias("a"), F.max(at_col).alias("b")).first()
    own = captures.select(*keys, host(F.col(url_col)).alias("host"))
    asked = own.select(*keys, "host", _bin(F.col(at_col)).alias("bin"), F.explode_outer(domains(F.col("host"))).alias("domain"))
    last = F.least(F.coalesce(F.col("valid_to"), F.lit(span["b"])), F.lit(span["b"]))
    first = F.greatest(F.col("valid_from"), F.lit(span["a"]))
    held = intervals.where(first <= last).select("*", F.explode(F.sequence(_bin(first), _bin(last))).alias("bin"))
    held = held.select(F.col("domain").alias("d"), F.col("bin").alias("b"), "category", "valid_from", "valid_to")
    active = (F.col("domain") == F.col("d")) & (F.col("bin") == F.col("b")) & (F.col(at_col) >= F.col("valid_from"))
    active &= F.col("valid_to").isNull() | (F.col(at_col) < F.col("valid_to"))
    found = asked.join(held, active, "left").groupBy(*keys, "host").agg(F.sort_array(F.collect_set("category")).alias("categories"))
    return found.withColumn("blocked", F.size("categories") > 0)
