"""Columns that only go along with a row, as one struct: their names cannot clash with any used on the way."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def packed(columns: list[str]) -> Column:
    """The named columns as one struct; of no columns a struct that nobody reads."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]) if columns else F.struct(F.lit(True).alias("nothing"))
