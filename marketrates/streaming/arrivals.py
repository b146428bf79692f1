"""Published files as a stream: each micro-batch of arrivals is checked against the stored hashes and its new snapshots replace their partitions.

The batch operators do the work, so a stream and a backfill give the same tables. A batch that is run again replaces the same partitions: the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.scope import replace_snapshots
from ..sources.snapshot_table import SnapshotTable


def stream_snapshots(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, column: str = "snapshot_id") -> StreamingQuery:
    """Follow a folder of Parquet files; rows of each batch's snapshots replace those stored. Runs until all that is there has been read."""

    def step(batch: DataFrame, _: int) -> None:
        ids = [r[0] for r in batch.select(column).distinct().collect()]  # a row per file that arrived
        if ids:
            replace_snapshots(batch, target, ids, column)

    files = spark.readStream.schema(schema).parquet(source)
    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_commits(source: str, table: SnapshotTable, checkpoint: str) -> StreamingQuery:
    """The same into a table of commits: each batch is one commit, so readers see its snapshots at once. A batch that is run again makes a commit equal to the one before."""

    def step(batch: DataFrame, _: int) -> None:
        ids = [r[0] for r in batch.select(table.column).distinct().collect()]  # a row per file that arrived
        if ids:
            table.replace(batch, ids)

    files = table.spark.readStream.schema(f"{table.schema}, {table.column} string").parquet(source)
    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
