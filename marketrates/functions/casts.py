"""Casts that give null instead of an error, and ratios that give null instead of infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text


def safe_cast(x: Column, kind: str) -> Column:
    return clean_text(x).try_cast(kind)


def safe_date(x: Column) -> Column:
    return safe_cast(x, "date")


def safe_timestamp(x: Column) -> Column:
    return safe_cast(x, "timestamp_ntz")


def safe_double(x: Column) -> Column:
    return safe_cast(x, "double")


def safe_decimal(x: Column) -> Column:
    """decimal(18,4), the type of all money."""
    return safe_cast(x, "decimal(18,4)")


def safe_bigint(x: Column) -> Column:
    return safe_cast(x, "bigint")


def ratio(x: Column, y: Column) -> Column:
    """x / y in double, null where y is 0 or null."""
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))
