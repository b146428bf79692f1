"""Surrogate keys and set signatures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_MODIFIERS = "<no_modifiers>"


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the columns' texts joined by '||', '<null>' for null. Do not put doubles in: their text differs between engines."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("<null>")) for c in columns]
    return F.md5(F.concat_ws("||", *texts))


def signature_text(values: Column, separator: str = "|") -> Column:
    """Aggregate: the distinct non-null values in order, joined; null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(values)), separator), F.lit(""))


def modifier_signature(values: Column) -> Column:
    """Aggregate: MD5 of the set of modifiers, or of the marker for none."""
    return F.md5(F.coalesce(signature_text(values), F.lit(NO_MODIFIERS)))
