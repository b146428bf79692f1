"""Writing tables: partitioned parts, publishing an allow-list at once, metadata, CSV downloads, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_partitioned(frame: DataFrame, path: str, by: str = "snapshot_id", records_per_file: int = 500_000) -> int:
    """Append rows by partition, files of at most so many rows; an empty frame still makes the folder. Returns the rows written, counted on the way.

    Rows are brought together by partition first, large ones split over tasks by AQE, so that files are few.
    """
    seen = Observation()
    frame.hint("rebalance", by).observe(seen, F.count("*").alias("rows")).write.mode("append").partitionBy(by).option("maxRecordsPerFile", records_per_file).parquet(path)
    return int(seen.get["rows"])


def _move(spark: SparkSession, source: str, target: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = hadoop.Path(f"{target}.old")
    system.delete(old, True)
    if system.exists(hadoop.Path(target)):
        system.rename(hadoop.Path(target), old)
    if not system.rename(hadoop.Path(source), hadoop.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")
    system.delete(old, True)


def publish(tables: dict[str, DataFrame], allowed: list[str], target: str) -> None:
    """Write the allowed tables beside the target, then swap the folder in by renames. A missing table is an error, others are not published."""
    missing = [n for n in allowed if n not in tables]
    if missing:
        raise ValueError(f"not there: {', '.join(missing)}")
    spark, staged = next(iter(tables.values())).sparkSession, f"{target}.staged"
    for name in allowed:
        tables[name].write.mode("overwrite").parquet(f"{staged}/{name}")
    _move(spark, staged, target)


def metadata(tables: dict[str, DataFrame], label: str, version: str) -> DataFrame:
    """table_name, row_count, column_count, label, contract_version, published_at: a row per table, counted in one job."""
    parts = [f.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count", F.lit(len(f.columns)).cast("long").alias("column_count")) for n, f in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).withColumns({"label": F.lit(label), "contract_version": F.lit(version), "published_at": F.current_timestamp()})


def write_csv(frame: DataFrame, path: str, rows: int, gzip_from: int = 100_000) -> None:
    """CSV with a header, gzip where there are many rows."""
    frame.write.mode("overwrite").option("header", True).option("compression", "gzip" if rows >= gzip_from else "none").csv(path)


def readiness(counts: DataFrame, least: dict[str, int]) -> DataFrame:
    """Issues: tables of a metadata frame with fewer rows than they should have, tables that are missing among them."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(list(least.items()), "table_name string, least long")
    own = wanted.join(counts.select("table_name", "row_count"), "table_name", "left")
    return own.filter(F.coalesce("row_count", F.lit(-1)) < F.col("least")).select("table_name", "row_count", "least", F.when(F.col("row_count").isNull(), "missing").otherwise("too few rows").alias("issue"))
