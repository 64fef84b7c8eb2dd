"""Row filters that recur across the operators."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rosterline.functions.columns import before


def active_only(df: DataFrame) -> DataFrame:
    """Records that are not deleted, by the first of three rules whose column exists."""
    rules = (
        ("deletedDate", lambda c: c.isNull()),
        ("deletedDateTime", lambda c: c.isNull()),
        ("state", lambda c: c == "active"),
    )
    for name, rule in rules:
        if name in df.columns:
            return df.where(rule(F.col(name)))
    return df


def live(removed: Column | str = "removed") -> Column:
    """Not a tombstone; an unknown flag counts as live."""
    column = F.col(removed) if isinstance(removed, str) else removed
    return ~F.coalesce(column, F.lit(False))


def none_like(text: Column, patterns: list[str]) -> Column:
    """The text matches none of the LIKE patterns."""
    return reduce(lambda a, b: a & b, (~text.like(p) for p in patterns))


def within(ts: Column, as_of: datetime, interval: str) -> Column:
    """``ts`` lies in the trailing window that ends at ``as_of``."""
    return ts.cast("timestamp_ntz") >= before(as_of, interval)


def changed_since(rows: DataFrame, modified: str, baseline: DataFrame, baseline_ts: str) -> DataFrame:
    """Rows modified at or after the newest baseline time.

    The newest time is a scalar subquery, so the plan stays one query and nothing visits
    the driver. Without a baseline no row qualifies.
    """
    newest = baseline.agg(F.max(baseline_ts)).scalar()
    return rows.where(F.col(modified) >= newest)
