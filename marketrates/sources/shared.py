"""Tables written once and read again: in the shared folder that the session names, below a folder of the application."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The application's folder in the one named by spark.checkpoint.dir; below /tmp/checkpoints where that is unset and all runs on one machine. On a cluster it must be named, as a machine's own
    folder is not shared."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return f"{(named or '/tmp/checkpoints').rstrip('/')}/{spark.sparkContext.applicationId}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table that is read again: what is used several times is computed once, and lineage ends there."""
    path = f"{folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def clear(spark: SparkSession) -> bool:
    """Delete all that the application wrote here; frames that still read it are void."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
