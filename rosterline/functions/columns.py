"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, functions as F

# Type markers of directory records, and the characters no file name may hold.
USER_MARKER = "#microsoft.graph.user"
GROUP_MARKER = "#microsoft.graph.group"
FORBIDDEN_IN_FILE_NAMES = r'[\\/*?:"<>|]'
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Markers inside the composite device text and the report's recency labels.
QUOTED_SEPARATOR = "','"
EMPTY_DEVICE = "T1"
QUOTED_PREFIX = "T2', '"
PLAIN_PREFIX = "T1', '"
RECENCY = (("1 day", "Last 24 hours"), ("3 days", "Last 3 days"), ("7 days", "Last 7 days"))
OLDER = "Last 30 days"


def principal_type(odata_type: Column) -> Column:
    """User, Group or Other from a record's type text."""
    return (
        F.when(odata_type.contains(USER_MARKER), "User")
        .when(odata_type.contains(GROUP_MARKER), "Group")
        .otherwise("Other")
    )


def file_safe(text: Column) -> Column:
    """The text without the characters a file name must not hold."""
    return F.regexp_replace(text, FORBIDDEN_IN_FILE_NAMES, "")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def values_of(text: Column, separator: str = ",") -> Column:
    """Trimmed parts of a separated list, as an array."""
    return F.transform(F.split(text, separator), lambda part: F.trim(part))


def before(as_of: datetime, interval: str) -> Column:
    """The instant ``interval`` before ``as_of``, without a time zone."""
    return F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")


def recency_label(ts: Column, as_of: datetime) -> Column:
    """The narrowest recency label whose window, ending at ``as_of``, holds ``ts``."""
    label = None
    for interval, name in RECENCY:
        inside = ts.cast("timestamp_ntz") >= before(as_of, interval)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(OLDER)


def build_version(composite: Column) -> Column:
    """The client build held in a composite device text; NULL for an empty device.

    Two layouts occur, told apart by their separator: a quoted comma, or else a plain one. The
    build is the first part less the layout's prefix. A text without any comma names no
    build: it is empty, or NULL for an empty device like the first part of any other.
    """
    quoted = composite.contains(QUOTED_SEPARATOR)
    first = F.split_part(composite, F.when(quoted, QUOTED_SEPARATOR).otherwise(","), F.lit(1))
    prefix = F.when(quoted, QUOTED_PREFIX).otherwise(PLAIN_PREFIX)
    build = F.when(composite.contains(","), F.replace(first, prefix, F.lit(""))).otherwise("")
    return F.when(first != EMPTY_DEVICE, build)


def new_run_id(prefix: str, at: datetime | None = None, suffix: str | None = None) -> str:
    """``prefix``, a UTC stamp and a random part; both parts may be given for repeatable runs."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")
    return "_".join([prefix, stamp, suffix or uuid4().hex[:8]])
