"""Snapshots: which are current, reading some of them, replacing and removing them.

Current is derived by recency, never stored as truth. Destructive calls refuse an empty scope. Plain Parquet has no transactions: a replace writes aside, drops the
named partitions and moves the new ones in, so readers in between may see neither. `sources.snapshot_table` makes the same changes as commits, which readers see whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def with_currentness(snapshots: DataFrame, publisher: str, order: list[str], start: str = "valid_from") -> DataFrame:
    """Add is_current and valid_to: the publisher's most recent snapshot is current, each other ends where the next begins."""
    latest = Window.partitionBy(publisher).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    forward = Window.partitionBy(publisher).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return snapshots.withColumn("is_current", F.row_number().over(latest) == 1).withColumn("valid_to", F.lead(start).over(forward))


def in_scope(frame: DataFrame, ids: list[str] | None, column: str = "snapshot_id") -> DataFrame:
    """Rows of the named snapshots, all of them if none is named; on a partition column this prunes files."""
    return frame.filter(F.col(column).isin(list(ids))) if ids else frame


def current_only(frame: DataFrame, snapshots: DataFrame, on: str = "snapshot_id") -> DataFrame:
    """Rows of current snapshots by the snapshot table, whatever flag the rows carry; a flag they carry is replaced."""
    current = snapshots.filter("is_current").select(on)
    return frame.drop("is_current").join(current, on, "left_semi").withColumn("is_current", F.lit(True))


def accepted(frame: DataFrame, rejected: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a rejected key; a null key matches none, so the row stays."""
    return frame.join(rejected.select(*on).distinct(), on, "left_anti")


def changed_arrivals(arrivals: DataFrame, publisher: str, order: list[str], digest: str) -> DataFrame:
    """Arrivals whose content differs from the publisher's one before."""
    before = F.lag(digest).over(Window.partitionBy(publisher).orderBy(*order))
    return arrivals.withColumn("previous", before).filter(~F.col(digest).eqNullSafe(F.col("previous"))).drop("previous")


def _need(ids) -> list[str]:
    ids = [str(x) for x in ids]
    if not ids or any(x in ("", "None") for x in ids):
        raise ValueError("name at least one snapshot, and none that is empty")
    return ids


def _drop_partitions(spark: SparkSession, path: str, column: str, ids: list[str]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for x in ids:
        part = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(x)
        system.delete(hadoop.Path(root, f"{column}={part}"), True)


def replace_snapshots(frame: DataFrame, path: str, ids, column: str = "snapshot_id", records_per_file: int = 500_000) -> None:
    """Replace the named snapshots' rows at path by frame's, also by none. Rows outside the scope, or without a snapshot, are an error.

    The new rows are written aside first, which may read from path itself; only when they are there are the old partitions dropped and the new ones moved in, a rename
    each. A failure before that leaves the table as it was.
    """
    ids, spark = _need(ids), frame.sparkSession
    inside = F.coalesce(F.col(column).cast("string").isin(ids), F.lit(False))
    seen = Observation()
    aside = f"{path.rstrip('/')}.replacing-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        frame.hint("rebalance", column).observe(seen, F.count_if(~inside).alias("outside")).write.partitionBy(column).option("maxRecordsPerFile", records_per_file).parquet(aside)
        if seen.get["outside"]:
            raise ValueError("rows outside the snapshots that are to be replaced")
        _drop_partitions(spark, path, column, ids)
        system.mkdirs(hadoop.Path(path))
        for part in system.listStatus(hadoop.Path(aside)):
            if part.isDirectory() and not system.rename(part.getPath(), hadoop.Path(path, part.getPath().getName())):
                raise OSError(f"{part.getPath()} could not be moved")
    finally:
        system.delete(hadoop.Path(aside), True)


def clear_snapshots(spark: SparkSession, paths: list[str], ids, column: str = "snapshot_id") -> None:
    ids = _need(ids)
    for path in paths:
        _drop_partitions(spark, path, column, ids)


def prune_stale(spark: SparkSession, paths: list[str], snapshots: DataFrame, mode: str = "current_only", column: str = "snapshot_id") -> list[str]:
    """Delete partitions of snapshots that are not current from each table; returns their ids. Mode all_snapshots keeps everything."""
    if mode == "all_snapshots":
        return []
    if mode != "current_only":
        raise ValueError(f"unknown mode {mode!r}")
    stale = [str(r[0]) for r in snapshots.filter("not is_current").select(column).collect()]  # a row per published file
    for path in paths if stale else []:
        _drop_partitions(spark, path, column, stale)
    return stale


def sync_current(stored: DataFrame, derived: DataFrame, on: str = "snapshot_id") -> DataFrame:
    """The stored snapshot table with is_current and valid_to as derived; snapshots that the derivation lacks keep theirs."""
    new = derived.select(on, F.col("is_current").alias("new_current"), F.col("valid_to").alias("new_valid_to"), F.lit(True).alias("seen"))
    out = stored.join(new, on, "left")
    out = out.withColumn("is_current", F.when(F.col("seen"), F.col("new_current")).otherwise(F.col("is_current")))
    return out.withColumn("valid_to", F.when(F.col("seen"), F.col("new_valid_to")).otherwise(F.col("valid_to"))).drop("new_current", "new_valid_to", "seen")
