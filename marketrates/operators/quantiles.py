"""Exact quantiles of columns of any size by selection: no task holds a column, nor more than its range of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared


def exact_quantiles(frame: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """group, then a column per quantile: interpolated between the two rows around rank (n - 1) * q of the group's values in order; nulls take no part.

    Equal values are counted first, on the map side too. What is left is ranged by group and value, written, and summed up within each range; a small table (a row per group and range that holds
    some of it) says how many values stand before a range. Then a value knows the ranks it holds, and only those around a wanted rank are kept: two for each quantile and group.
    """
    counts = frame.filter(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    ranged = counts.repartitionByRange(*[F.col(c).asc_nulls_first() for c in group], "_value").withColumn("_part", F.spark_partition_id())
    ranged = shared.written(ranged, "ranged")
    named = [F.col(c).alias(f"_{c}") for c in group]
    runs = ranged.groupBy(*group, "_part").agg(F.sum("_n").alias("_rows"))
    whole, earlier = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_total": F.sum("_rows").over(whole), "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))})
    within = Window.partitionBy(*group, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ranged.withColumn("_upto", F.sum("_n").over(within))
    same = F.col("_part") == F.col("_own")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    own = own.join(runs.select(*named, F.col("_part").alias("_own"), "_total", "_before"), same)
    last = F.col("_before") + F.col("_upto") - 1  # ranks from 0
    first = last - F.col("_n") + 1
    rank = lambda q: (F.col("_total") - 1) * F.lit(float(q))
    holds = lambda r: (first <= r) & (r <= last)
    wanted = F.lit(False)
    for q in quantiles.values():
        wanted = wanted | holds(F.floor(rank(q))) | holds(F.ceil(rank(q)))
    kept = own.filter(wanted)
    ends = [F.max(F.when(holds(f(rank(q))), F.col("_value"))).alias(f"_{k}_{name}") for name, q in quantiles.items() for k, f in (("low", F.floor), ("high", F.ceil))]
    both = kept.groupBy(*group).agg(F.max("_total").alias("_total"), *ends)
    out = []
    for name, q in quantiles.items():
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        share = rank(q) - F.floor(rank(q))
        out.append(F.when(low == high, low).otherwise(low * (1 - share) + high * share).alias(name))
    return both.select(*group, *out)
