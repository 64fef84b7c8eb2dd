"""Landed change-feed pages: envelopes in, one row per record out.

A page is one JSON envelope ``{value: [...], @odata.nextLink, @odata.deltaLink}`` landed
with its scope, batch, page number and time of receipt. Only the last page of a finished
batch carries a delta link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterline.functions.columns import principal_type
from rosterline.operators.keyed import latest_per_key
from rosterline.workspace import sized

BATCH = ("scope", "batch_id")


def envelope_schema(record: str) -> str:
    """The envelope around records of a DDL layout."""
    return (
        "scope STRING, batch_id STRING, page_seq BIGINT, received_ts TIMESTAMP_NTZ, error STRING, "
        f"value ARRAY<STRUCT<{record}>>, `@odata.nextLink` STRING, `@odata.deltaLink` STRING"
    )


def read_pages(spark: SparkSession, path: str | list[str], record: str, base: str | None = None) -> DataFrame:
    """Envelopes below ``path`` with ``next_link`` and ``delta_link`` columns.

    Below ``base``, folders named ``scope=`` and ``batch_id=`` stand for these two fields.
    """
    reader = spark.read.schema(envelope_schema(record))
    if base:
        reader = reader.option("basePath", base)
    return (
        reader.json(path)
        .withColumnsRenamed({"@odata.nextLink": "next_link", "@odata.deltaLink": "delta_link"})
    )


def batch_status(pages: DataFrame, batch: tuple[str, ...] = BATCH) -> DataFrame:
    """Per batch: pages, records, resume token, and whether the batch may be committed.

    A page landed twice counts once, and a page is good when one of its landings is; its
    records are those of the landing that :func:`good_landings` takes.
    Complete means every page up to the last is good and the last one carries the token.
    """
    good = F.col("error").isNull()
    per_page = pages.groupBy(*batch, "page_seq").agg(
        F.max_by(
            F.coalesce(F.size("value"), F.lit(0)), F.when(good, F.struct("received_ts", _content(pages, batch)))
        ).cast("bigint").alias("records"),
        F.max("received_ts").alias("received_ts"),
        F.max(F.when(good, F.col("delta_link"))).alias("delta_link"),
        F.max(good).alias("is_good"),
    )
    token_page = F.when(F.col("delta_link").isNotNull(), F.col("page_seq"))
    return per_page.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.max("received_ts").alias("received_ts"),
        F.max_by("delta_link", token_page).alias("delta_link"),
        F.coalesce(
            F.min("is_good")
            & (F.count(F.lit(1)) == F.max("page_seq") + 1)
            & (F.max(token_page) == F.max("page_seq")),
            F.lit(False),
        ).alias("is_complete"),
    )


def page_counts(pages: DataFrame, batch: tuple[str, ...] = BATCH) -> DataFrame:
    """Records of every page, of the landing that counts; an error or no records give 0."""
    good = F.when(F.col("error").isNull(), F.struct("received_ts", _content(pages, batch)))
    size = F.coalesce(F.size("value"), F.lit(0))
    counted = pages.groupBy(*batch, "page_seq").agg(F.max_by(size, good).alias("records"), F.max("received_ts").alias("received_ts"))
    return counted.select(*batch, "page_seq", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"), "received_ts")


def good_landings(pages: DataFrame, batch: tuple[str, ...] = BATCH) -> DataFrame:
    """One row per page without an error: the landing received last, ties by content."""
    good = pages.where(F.col("error").isNull())
    order = ["received_ts", "__content"]
    return latest_per_key(good.withColumn("__content", _content(pages, batch)), [*batch, "page_seq"], order).drop("__content")


def _content(pages: DataFrame, batch: tuple[str, ...]) -> Column:
    """A digest that puts landings of one page and time in a fixed order."""
    return F.sha2(F.to_json(F.struct(*[c for c in pages.columns if c not in batch])), 256)


def flatten_pages(pages: DataFrame, only_complete: bool = True, batch: tuple[str, ...] = BATCH) -> DataFrame:
    """One row per record, by default of complete batches only, in the order (page, position).

    A page that was landed twice (a retry) counts once: its good landing received last, of
    several at one time the one that compares greatest.
    """
    if only_complete:
        complete = sized(batch_status(pages, batch).where("is_complete").select(*batch), "complete-batches")
        pages = pages.join(complete, list(batch), "left_semi")
    once = good_landings(pages, batch)
    return once.select(
        *batch, "page_seq", "received_ts", F.posexplode("value").alias("position", "record")
    )


def group_rows(records: DataFrame, keep: tuple[str, ...] = ("batch_id", "received_ts")) -> DataFrame:
    """Group attribute rows; a tombstone keeps its id and ``removed`` is true."""
    r = F.col("record")
    return records.where(r.getField("id").isNotNull()).select(
        r.getField("id").alias("group_id"),
        r.getField("@removed").isNotNull().alias("removed"),
        r.getField("displayName").alias("display_name"),
        r.getField("mail").alias("mail"),
        r.getField("securityEnabled").alias("security_enabled"),
        r.getField("mailEnabled").alias("mail_enabled"),
        r.getField("groupTypes").alias("group_types"),
        r.getField("description").alias("description"),
        F.try_to_timestamp(r.getField("lastModifiedDateTime")).cast("timestamp_ntz").alias("last_modified"),
        F.to_json(r).alias("raw_json"),
        *keep,
        *[c for c in ("page_seq", "position") if c in records.columns],
    )


def link_changes(records: DataFrame, list_field: str, id_name: str, keep: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Nested member or owner changes: one row per change with ``action`` add or remove.

    ``list_field`` is ``members@delta`` or ``owners@delta``. A removed group's lists are ignored.
    """
    r = F.col("record")
    live = records.where(r.getField("id").isNotNull() & r.getField("@removed").isNull())
    exploded = live.select(
        r.getField("id").alias("group_id"),
        F.posexplode(r.getField(list_field)).alias("change_position", "change"),
        *keep,
        "page_seq",
        "position",
    )
    removed = F.col("change").getField("@removed").isNotNull()
    return exploded.select(
        "group_id",
        F.col("change").getField("id").alias(id_name),
        F.when(removed, "remove").otherwise("add").alias("action"),
        *keep,
        "page_seq",
        "position",
        "change_position",
    )


def principal_rows(records: DataFrame, keep: tuple[str, ...] = ("batch_id", "received_ts")) -> DataFrame:
    """Members of one group's member feed (the scope names the group), with their kind."""
    r = F.col("record")
    return records.select(
        F.col("scope").alias("group_id"),
        r.getField("id").alias("principal_id"),
        principal_type(r.getField("@odata.type")).alias("principal_type"),
        F.to_json(r).alias("raw_json"),
        *keep,
    )


def user_rows(records: DataFrame, keep: tuple[str, ...] = ("batch_id", "received_ts")) -> DataFrame:
    """User attribute rows of the user feed."""
    r = F.col("record")
    return records.where(r.getField("id").isNotNull()).select(
        r.getField("id").alias("user_object_id"),
        r.getField("userPrincipalName").alias("user_upn"),
        r.getField("displayName").alias("display_name"),
        r.getField("mail").alias("mail"),
        r.getField("accountEnabled").alias("account_enabled"),
        r.getField("@removed").isNotNull().alias("removed"),
        F.try_to_timestamp(r.getField("lastModifiedDateTime")).cast("timestamp_ntz").alias("last_modified"),
        F.to_json(r).alias("raw_json"),
        *keep,
        *[c for c in ("page_seq", "position") if c in records.columns],
    )


def fan_out(keys: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """0..n records for every wanted key, each key carrying ``key_complete``.

    A key with a failed, missing or unfinished page is kept and flagged, never dropped:
    its absence of records must not be read as a removal. A key without records gives one
    row whose ``record`` is NULL.
    """
    status = batch_status(pages, (key,)).select(key, "records", "is_complete")
    wanted = keys.select(key).distinct().join(status, key, "left").select(
        key,
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("is_complete", F.lit(False)).alias("key_complete"),
    )
    records = flatten_pages(pages, only_complete=False, batch=(key,)).select(key, "page_seq", "position", "record")
    held = records.join(wanted.drop("records"), key)
    return held.unionByName(wanted.where("records = 0").drop("records"), allowMissingColumns=True)
