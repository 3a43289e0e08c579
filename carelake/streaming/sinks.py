"""Streaming sinks. Every query has a checkpoint folder of its own, below a shared root."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from carelake.session import path_exists
from carelake.sources.tables import VersionedTable
from carelake.sources.writers import LakeLayout


def _trigger(writer, every: str | None):
    """A processing-time trigger, or with ``None`` one run over all data now available."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def append_rows(
    stream: DataFrame,
    path: str,
    checkpoint_root: str,
    name: str,
    every: str | None = "30 seconds",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a Parquet folder, each row exactly once across restarts."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, every).start(path)


def append_layer(
    stream: DataFrame,
    layout: LakeLayout,
    layer: str,
    table: str,
    every: str | None = "30 seconds",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a lake table, checkpointed under the layout's checkpoint layer."""
    return append_rows(
        stream, layout.path(layer, table), layout.path("checkpoints"), f"{layer}-{table}", every, partition_by
    )


def replace_result(
    aggregate: DataFrame, root: str, checkpoint_root: str, name: str, every: str | None = "1 minute"
) -> StreamingQuery:
    """Keep the whole current result of an aggregate: every trigger commits it as a new version of
    a versioned table. The commit is named by query and batch number, so a batch that runs again
    writes its own version once more, and a query with a new checkpoint goes on after the last."""

    def publish(rows: DataFrame, batch: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        VersionedTable(rows.sparkSession, root).commit(rows, "STREAMING UPDATE", token=f"{query}/{batch}")

    writer = aggregate.writeStream.outputMode("complete").foreachBatch(publish)
    writer = writer.option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
    return _trigger(writer, every).start()


def print_rows(stream: DataFrame, every: str | None = "10 seconds", rows: int = 20) -> StreamingQuery:
    """Show each micro-batch on the console, for debugging."""
    writer = stream.writeStream.outputMode("append").format("console")
    return _trigger(writer.option("truncate", "false").option("numRows", rows), every).start()


def drain(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an available-now query; its failure is raised here."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} still runs")


def with_stream(spark: SparkSession, stored: DataFrame, streamed_path: str) -> DataFrame:
    """Stored rows plus the rows a stream has landed so far; the stored rows alone when the stream
    has landed no file yet. Anything else that cannot be read is an error."""
    if not path_exists(spark, streamed_path):
        return stored
    try:
        landed = spark.read.parquet(streamed_path)
    except AnalysisException as failure:
        if failure.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return stored
        raise
    return stored.unionByName(landed, allowMissingColumns=True)


def progress_lag_seconds(query: StreamingQuery, as_of) -> float | None:
    """Seconds between an aware instant and the newest event time of the last micro-batch."""
    progress = query.lastProgress
    newest = (progress or {}).get("eventTime", {}).get("max")
    if not newest:
        return None
    return (as_of - datetime.fromisoformat(newest.replace("Z", "+00:00"))).total_seconds()
