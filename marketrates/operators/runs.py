"""Operational marts from the records of runs, attempts and nodes, which arrive in any order and more than once.

A run's state is a fold that does not depend on the order of its events: the greatest by (completed, time, event). So a batch over all events, a stream over some at a time and a fold over what the
stream wrote give the same rows, and an event that comes twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

OPEN = "running_or_interrupted"


def latest_runs(events: DataFrame, key: str = "run_id", tie: str = "event_id") -> DataFrame:
    """One row per run, that of its last event, completed ones before others; terminal_status is OPEN where none completed.

    events: the key, state, terminal_status, started_at, ended_at, tie and any more columns. A partial maximum is taken map-side, so a run of any number of events is one row per task.
    """
    rest = [c for c in events.columns if c != key]
    order = F.struct((F.col("state") == "completed").alias("done"), F.coalesce("ended_at", "started_at").alias("at"), F.col(tie).alias("tie"))
    best = events.groupBy(key).agg(F.max(F.struct(order.alias("order"), *rest)).alias("x")).select(key, *[F.col(f"x.{c}").alias(c) for c in rest])
    return best.withColumn("terminal_status", F.when(F.col("state") == "completed", F.col("terminal_status")).otherwise(OPEN))


def stream_runs(spark: SparkSession, source: str, schema: str, log: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Follow a folder of event files; each micro-batch's states go to log/batch=<n>, which is replaced if the batch runs again. `read_runs` gives the runs."""

    def step(batch: DataFrame, n: int) -> None:
        latest_runs(batch.withColumn("told_status", F.col("terminal_status"))).write.mode("overwrite").parquet(f"{log}/batch={n}")

    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_runs(spark: SparkSession, log: str) -> DataFrame:
    """The runs as of all batches: the same fold over the states of each."""
    states = spark.read.parquet(log).drop("batch", "terminal_status").withColumnRenamed("told_status", "terminal_status")
    return latest_runs(states)


def map_counts(attempts: DataFrame, keys: list[str], maps: dict[str, str]) -> DataFrame:
    """A row per entry of each map column of counts: keys, count_type, table_name, row_count. maps: the count's type -> the column."""
    def entries(kind: str, column: str) -> Column:
        whole = F.map_entries(F.coalesce(column, F.create_map().cast("map<string,bigint>")))
        return F.transform(whole, lambda e: F.struct(F.lit(kind).alias("count_type"), e["key"].alias("table_name"), e["value"].alias("row_count")))

    return attempts.select(*keys, F.inline(F.flatten(F.array(*[entries(kind, c) for kind, c in maps.items()]))))


def row_count_meaning(resource_type: Column, materialization: Column) -> Column:
    """What a node's count of rows says."""
    return (
        F.when(resource_type == "test", "use_test_failures").when(materialization == "view", "not_applicable").when(materialization == "incremental", "rows_written_this_run")
        .when(materialization == "table", "rebuilt_table_rows").when(resource_type == "seed", "rows_seeded").otherwise("unknown")
    )


def node_results(nodes: DataFrame, attempts: DataFrame, runs: DataFrame) -> DataFrame:
    """Nodes of known runs with the run's command and status, the attempt's ordinal and status where it is known, and what their counts mean."""
    own = nodes.withColumn("row_count_semantics", row_count_meaning(F.col("resource_type"), F.col("materialization")))
    own = own.join(runs.select("run_id", F.col("command").alias("run_command"), F.col("terminal_status").alias("run_terminal_status")), "run_id")
    return own.join(attempts.select("attempt_id", "attempt_ordinal", F.col("status").alias("attempt_status")), "attempt_id", "left")
