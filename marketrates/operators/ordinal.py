"""Ordinals over tables of any size: no task sees more than its range of the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared

#: Bits of monotonically_increasing_id below the partition's number.
INDEX_BITS = 33


def with_ordinals(frame: DataFrame, group: list[str], order: list, name: str = "ordinal", first: int = 1) -> DataFrame:
    """Add each row's place in its group by the order, counted from `first`; groups may be as large as the table, and null is a group too.

    Rows are ranged by group and order over the partitions and sorted there; a row's index within its partition is known without a shuffle, and a small table (a row per
    group and partition that holds some of it) gives what earlier partitions hold of the group. Rows alike in group and order follow each other in the order in which they were read.
    The ranged rows are written once, so that the sampled borders are the same for both uses.
    """
    clash = {"_row", "_at", "_part", "_least", "_n", "_before"} & set(frame.columns)
    if clash:
        raise ValueError(f"columns kept for the ordinal: {', '.join(sorted(clash))}")
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = frame.withColumn("_row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*[F.col(c).asc_nulls_first() for c in group], *keys, "_row").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in group], *keys, "_row")
    ranged = shared.written(ranged.drop("_row").withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", INDEX_BITS))
    runs = ranged.groupBy(*group, "_part").agg(F.min("_at").alias("_least"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    marked = runs.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_part").alias("_own"), "_least", "_before")
    same = F.col("_part") == F.col("_own")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = ranged.join(marked, same)
    return out.withColumn(name, (F.col("_at") - F.col("_least") + F.col("_before") + first).cast("long")).select(*frame.columns, name)
