"""Expectations that return the rows that break them, reconciliations, gates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull())


def in_values(frame: DataFrame, column: str, values: list) -> DataFrame:
    return frame.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def unique(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return frame.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def related(frame: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value has no row in the other table; nulls are fine."""
    keys = other.select(F.col(other_column).alias("_key")).distinct()
    return frame.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def missing_rows(source: DataFrame, arrived: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that neither arrived nor were rejected."""
    return source.select(*keys).join(arrived.select(*keys).distinct(), keys, "left_anti").join(rejected.select(*keys).distinct(), keys, "left_anti")


def differing(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of either side whose values differ from the other side's, nulls equal."""
    other = right.select(*keys, *[F.col(v).alias(f"_{v}") for v in values], F.lit(True).alias("_right"))
    both = left.select(*keys, *values, F.lit(True).alias("_left")).join(other, keys, "full")
    same = reduce(lambda a, b: a & b, [F.col(v).eqNullSafe(F.col(f"_{v}")) for v in values], F.col("_left").isNotNull() & F.col("_right").isNotNull())
    return both.filter(~same).drop("_left", "_right")


def reconcile(summary: DataFrame, again: DataFrame, keys: list[str], tolerances: dict[str, float]) -> DataFrame:
    """Keys at which a summary differs from its recomputation by another route: the key, side ('summary', 'again' or 'both' have it) and the names of the values that differ.

    Keys and values may be null, which equals null; numbers may differ by their tolerance.
    """
    left = summary.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in tolerances], F.lit(True).alias("_l"))
    right = again.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_r_{c}") for c in tolerances], F.lit(True).alias("_r"))
    both = left.join(right, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]), "full")
    side = F.when(F.col("_r").isNull(), "summary").when(F.col("_l").isNull(), "again").otherwise("both")

    def differs(c: str, tolerance: float) -> Column:
        a, b = F.col(f"_l_{c}").cast("double"), F.col(f"_r_{c}").cast("double")
        return ~(a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False)))

    names = F.filter(F.array(*[F.when(differs(c, t), c) for c, t in tolerances.items()]), lambda x: x.isNotNull())
    out = both.select(*[F.when(F.col("_l").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys], side.alias("side"), names.alias("differing"))
    return out.filter((F.col("side") != "both") | (F.size("differing") > 0))


def sparsity(frame: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, column_name, row_count, present_count, present_rate: how often each column is filled, from one grouping."""
    counts = frame.groupBy(*by).agg(F.count("*").alias("row_count"), *[F.count(c).alias(f"_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("present_count")) for c in columns])
    rate = F.round(F.try_divide(F.col("present_count"), F.col("row_count")), 6).alias("present_rate")
    return counts.select(*by, "row_count", F.inline(cells)).select(*by, "column_name", "row_count", "present_count", rate)


def not_monotone(frame: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value exceeds that of the row before in their group: stages of a funnel only lose."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(order))
    return frame.withColumn("previous", before).filter(F.col(value) > F.col("previous"))


def outside(frame: DataFrame, columns: list[str], low: float, high: float) -> DataFrame:
    """Rows with a value beyond the bounds; nulls are fine."""
    return frame.filter(reduce(lambda a, b: a | b, [~F.col(c).between(low, high) for c in columns]))


@dataclass(frozen=True)
class Gate:
    """A measure that must hold before anything is built. share: the numerator's part of the denominator in hundredths, at least the threshold, and failed where there are no rows; else the
    rows that block, at most the threshold. Without a threshold it only informs."""

    name: str
    numerator: str
    denominator: str
    threshold: float | None
    share: bool = True


def gate_rows(measures: DataFrame, specs: list[Gate]) -> DataFrame:
    """gate, metric_value, threshold, status, numerator_count, denominator_count, blocker_count: a row per gate of a one-row frame of counts."""
    cells = []
    for g in specs:
        n, d = F.coalesce(F.col(g.numerator), F.lit(0)).cast("long"), F.coalesce(F.col(g.denominator), F.lit(0)).cast("long")
        value = F.try_divide(100.0 * n, d) if g.share else (d - n).cast("double")
        passed = value >= g.threshold if g.share else value <= g.threshold
        status = F.lit("info") if g.threshold is None else F.when(passed, "pass").otherwise("fail")
        cells.append(F.struct(
            F.lit(g.name).alias("gate"), F.round(value, 2).alias("metric_value"), F.lit(g.threshold).cast("double").alias("threshold"), status.alias("status"),
            n.alias("numerator_count"), d.alias("denominator_count"), (d - n).alias("blocker_count"),
        ))
    return measures.select(F.explode(F.array(*cells)).alias("g")).select("g.*")


def gates(measures: DataFrame, thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """A row per gate of a one-row frame of measures: metric, value, threshold, passed; a threshold is ('min' or 'max', bound); what cannot be measured has not passed."""
    cells = []
    for metric, (kind, bound) in thresholds.items():
        value = F.col(metric).cast("double")
        cells.append(F.struct(F.lit(metric).alias("metric"), value.alias("value"), F.lit(float(bound)).alias("threshold"), F.coalesce(value >= bound if kind == "min" else value <= bound, F.lit(False)).alias("passed")))
    return measures.select(F.explode(F.array(*cells)).alias("g")).select("g.*")


def counts_of(checks: dict[str, DataFrame]) -> DataFrame:
    """check, failing: how many rows break each."""
    return reduce(lambda a, b: a.unionByName(b), [f.agg(F.count("*").alias("failing")).select(F.lit(name).alias("check"), "failing") for name, f in checks.items()])
