"""Unpivot, explode, split and pivot. Arrays of structs and one explode: never a self join, never a scan per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text


def unpivot_measures(frame: DataFrame, measures: list[dict], value: str = "amount_value") -> DataFrame:
    """One row per measure that is there. A measure is {'value': Column, and a literal or a Column for each other column}; 'present' says when it is there, else a value does."""
    names = [k for k in measures[0] if k not in ("value", "present")]
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    cells = [F.when(m.get("present", m["value"].isNotNull()), F.struct(*[lit(m[n]).alias(n) for n in names], m["value"].alias(value))) for m in measures]
    cell = F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("cell")
    return frame.select("*", cell).select("*", "cell.*").drop("cell")


def unpivot_slots(frame: DataFrame, slots: list[tuple[str, str]], ids: list[str]) -> DataFrame:
    """(ids, code_ordinal, code, code_type) for each pair of columns whose code has a value.

    Rows are brought to the grain of ids and slots first, so that what fans out below them does not multiply codes.
    """
    columns = [c for pair in slots for c in pair]
    own = frame.select(*ids, *columns).distinct()
    cells = [F.struct(F.lit(i).cast("long").alias("code_ordinal"), clean_text(F.col(c), lowercase=False).alias("code"), clean_text(F.col(t)).alias("code_type")) for i, (c, t) in enumerate(slots, 1)]
    cell = F.explode(F.filter(F.array(*cells), lambda c: c["code"].isNotNull())).alias("cell")
    return own.select(*ids, cell).select(*ids, "cell.*")


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with more columns, each computed once a row: taken through an array of one they stay below what reads them; by themselves they are written out again wherever a filter names them."""
    own = frame.select("*", *[c.alias(n) for n, c in columns.items()])
    return own.select(*frame.columns, F.explode_outer(F.array(F.struct(*columns))).alias("_once")).select(*frame.columns, "_once.*")


def split_ordinal(frame: DataFrame, column: str, separator: str = "|", value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """One row per part of a delimited text, ordinals from 0; blank parts go."""
    parts = F.posexplode(F.split(column, f"[{separator}]")).alias(ordinal, value)
    return frame.select("*", parts).withColumn(value, F.trim(value)).filter(F.col(value) != "")


def explode_map(frame: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    return frame.select(*[c for c in frame.columns if c != column], F.explode(column).alias(key, value))


def union_keys(frame: DataFrame, left: str, right: str, key: str = "key") -> DataFrame:
    """A row for each key of either map, with both maps' values."""
    keys = F.array_distinct(F.concat(F.coalesce(F.map_keys(left), F.array().cast("array<string>")), F.coalesce(F.map_keys(right), F.array().cast("array<string>"))))
    own = frame.withColumn(key, F.explode(keys))
    return own.withColumn(f"{left}_value", F.try_element_at(F.col(left), F.col(key))).withColumn(f"{right}_value", F.try_element_at(F.col(right), F.col(key))).drop(left, right)


def columns_to_rows(frame: DataFrame, labels: dict[str, tuple], names: list[str], value: str, keep: list[str] = []) -> DataFrame:
    """A row per column of labels: its labels under names, its value under value; nulls stay."""
    cells = [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, own)], F.col(c).alias(value)) for c, own in labels.items()]
    return frame.select(*keep, F.explode(F.array(*cells)).alias("cell")).select(*keep, "cell.*")


def pivot_back(frame: DataFrame, ids: list[str], key: str, value: str, columns: dict[str, str]) -> DataFrame:
    """One row per ids; columns maps a key's value to its column's name. One conditional aggregate, no pivot discovery pass."""
    return frame.groupBy(*ids).agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(name) for k, name in columns.items()])


def profile_columns(frame: DataFrame, columns: list[str], grain: str) -> DataFrame:
    """Long form of numeric-looking columns: (grain, column_name, raw_value)."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_value")) for c in columns]
    return frame.select(F.lit(grain).alias("grain"), F.explode(F.array(*cells)).alias("cell")).select("grain", "cell.*")


def with_bands(frame: DataFrame, bands: list[str], name: str = "band") -> DataFrame:
    """Every row once for each band."""
    return frame.withColumn(name, F.explode(F.array(*[F.lit(b) for b in bands])))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def non_null_names(flags: dict[str, Column]) -> Column:
    """Array of the names of the flags that hold, in order."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda x: x.isNotNull())
