"""Progress of running streams as a table, so that alert rules read what the queries say of themselves."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from carelake import schemas
from carelake.session import path_exists


class ProgressTable(StreamingQueryListener):
    """Appends a row for each micro-batch of the session's streams to a Parquet table: query, run,
    batch, time of the trigger, rows read, newest event time (null without a watermark or rows) and
    watermark. ``names`` limits it to queries of these names.

    Use it as a context: it listens from entry to exit. A batch that runs again after a restart has
    its own row with the new run; ``rows()`` gives the last of each batch.
    """

    def __init__(self, spark: SparkSession, path: str, names: set[str] | None = None) -> None:
        self.spark, self.path, self.names = spark, path.rstrip("/"), names
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        if self.names is not None and name not in self.names:
            return
        times = dict(p.eventTime or {})
        row = (name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, times.get("max"), times.get("watermark"))
        text = self.spark.createDataFrame([row], "query string, run string, batch bigint, at string, rows bigint, newest string, watermark string")
        stamped = text.withColumns({c: text[c].cast("timestamp") for c in ("at", "newest", "watermark")})
        stamped.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def drained(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until the query has ended and all its batches are in the table."""
        query.awaitTermination()
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"no word of the end of {query.name or query.id}")

    def rows(self) -> DataFrame:
        """The last row of each batch of each query; none before the first batch has ended."""
        return read_progress(self.spark, self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.PROGRESS)
    rows = spark.read.schema(schemas.PROGRESS).parquet(path)
    others = [c for c in rows.columns if c not in ("query", "batch")]
    last = rows.groupBy("query", "batch").agg(F.max_by(F.struct(*others), F.struct("at", "run")).alias("__last"))
    return last.select("query", "batch", "__last.*").select(*rows.columns)
