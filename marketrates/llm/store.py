"""Where intermediate tables live, and how they are written and read again."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources import shared

_tables: dict[str, list[str]] = {}
#: Rows and bytes in one Arrow batch, whichever comes first: a batch of whole texts must fit a Python worker, and offsets of 32 bits.
BATCH_ROWS, BATCH_BYTES = 1000, 64 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the folder named in spark.checkpoint.dir."""
    return f"{shared.folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, those in the catalog too; frames that still read them are void."""
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    shared.clear(spark)


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers, where neither PYTHONPATH nor the working folder already has it."""
    top = pathlib.Path(__file__).resolve().parents[2]
    known = {pathlib.Path(p or ".").resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]}
    context = spark.sparkContext
    if top in known or getattr(context, "_package_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="spark-package-")  # the driver serves it as long as it runs
    context.addPyFile(shutil.make_archive(f"{folder}/package", "zip", top, pathlib.Path(__file__).parents[1].name))
    context._package_shipped = True


def tune(spark: SparkSession) -> None:
    """Session settings that bound what one Python worker holds; the package where the workers lack it.

    The settings stay, since plans made now run later.
    """
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def written(frame: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write the frame to the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation.

    The write's own shuffle files are dropped when it ends; the setting is put back for the caller's later plans.
    """
    spark = frame.sparkSession
    path, key = scratch(spark, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        frame.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bucketed(frame: DataFrame, name: str, key: str) -> DataFrame:
    """Write the frame as a table bucketed and sorted by the key, in the shared folder: later joins on the key do not shuffle it again."""
    spark = frame.sparkSession
    table, n, setting = f"{name}_{uuid.uuid4().hex}", partitions(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        frame.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", "zstd").option("path", scratch(spark, name)).saveAsTable(table)
    finally:
        spark.conf.set(setting, before)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)
