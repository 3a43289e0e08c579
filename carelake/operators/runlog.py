"""Operational analytics over run-log tables.

Input: one row per stage execution with ``run_id, stage, started, duration, records`` and, where
an operator needs them, ``source, error_type, bytes_written, bytes_transferred``. All operators
first reduce the log to (run, stage) or (stage, time bucket); only that reduced table is ranked or
scanned in order, so a stage that produced a third of the log is spread over all tasks.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from carelake import fixed_values as fx
from carelake.columns import refs
from carelake.functions import records

LOG_SCHEMA = (
    "run_id string, stage string, started timestamp, duration double, records bigint, source string, "
    "error_type string, bytes_written bigint, bytes_transferred bigint"
)
_FLOOR_SECONDS = 0.001


# -- stage profile -------------------------------------------------------------------------------


def _per_stage(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id", "stage").agg(
        F.sum("duration").alias("duration"),
        F.sum("records").alias("records"),
        F.min("started").alias("started"),
    )


def stage_profile(log: DataFrame) -> DataFrame:
    """Duration, records, throughput and share of the run for each stage. The window holds the
    distinct stages of one run, not its log rows."""
    run_total = F.sum("duration").over(W.partitionBy("run_id"))
    floored = F.greatest(F.col("duration"), F.lit(_FLOOR_SECONDS))
    share = F.col("duration") / F.greatest(run_total, F.lit(_FLOOR_SECONDS)) * 100
    return _per_stage(log).select(
        "run_id",
        "stage",
        records.nearest(F.col("duration"), 3).alias("duration_seconds"),
        "records",
        records.nearest(F.col("records") / floored, 2).alias("records_per_second"),
        records.nearest(share, 1).alias("pct_of_total"),
    )


def run_report(log: DataFrame) -> DataFrame:
    """Per run: total time, throughput and the longest stage (the earliest of equals; empty when
    no stage took any time)."""
    longest = F.max_by("stage", F.struct(F.col("duration"), -F.unix_micros("started")))
    total = F.sum("duration")
    return _per_stage(log).groupBy("run_id").agg(
        records.nearest(total, 3).alias("total_duration_seconds"),
        records.nearest(F.sum("records") / F.greatest(total, F.lit(_FLOOR_SECONDS)), 2).alias("records_per_second"),
        F.when(F.max("duration") > 0, longest).otherwise(F.lit("")).alias("bottleneck_stage"),
    )


def stage_timing(log: DataFrame) -> DataFrame:
    """Seconds per stage and, with a null stage, per run. The log is read once, and only its
    per-stage sums are expanded to the two levels."""
    return (
        _per_stage(log)
        .rollup("run_id", "stage")
        .agg(F.sum("duration").alias("seconds"), F.grouping_id().alias("level"))
        .where(F.col("level") <= 1)
        .select("run_id", "stage", "seconds")
    )


def stage_latency(log: DataFrame) -> DataFrame:
    return log.groupBy("stage").agg(F.mean("duration").alias("avg_latency"))


# -- cost ----------------------------------------------------------------------------------------


def run_cost(
    log: DataFrame,
    nodes: int = 2,
    include_broker: bool = True,
    include_database: bool = True,
    prices: Mapping[str, float] = fx.PRICES,
) -> DataFrame:
    """Estimated US$ per run; each item rounded to 4 digits, the total is the sum of the items."""
    per_run = log.groupBy("run_id").agg(
        (F.sum("duration") / 3600).alias("hours"),
        F.sum("records").alias("records_processed"),
        (F.sum("bytes_written") / float(1024**3)).alias("gb_written"),
        (F.sum("bytes_transferred") / float(1024**3)).alias("gb_moved"),
    )
    hours = F.col("hours")
    items: dict[str, Column] = {
        "compute_cost_usd": hours * (nodes * prices["node_hour"]),
        "storage_cost_usd": F.col("gb_written") * prices["storage_gb_month"] / fx.DAYS_PER_MONTH,
        "request_cost_usd": F.col("records_processed") / 1000 * prices["put_per_1000"],
        "transfer_cost_usd": F.col("gb_moved") * prices["transfer_gb"],
    }
    if include_broker:
        items["broker_cost_usd"] = hours * prices["broker_hour"] * fx.BROKER_COUNT
    if include_database:
        items["database_cost_usd"] = hours * prices["database_hour"]
    priced = per_run.select(
        "run_id", "records_processed", *[records.nearest(cost, 4).alias(name) for name, cost in items.items()]
    )
    total = sum((F.col(name) for name in list(items)[1:]), F.col(next(iter(items))))
    per_record = total / F.greatest(F.col("records_processed"), F.lit(1))
    return priced.select(
        "*", records.nearest(total, 4).alias("total_cost_usd"), records.nearest(per_record, 8).alias("cost_per_record_usd")
    )


# -- counters and histograms ---------------------------------------------------------------------


def counters(log: DataFrame) -> DataFrame:
    """Records by (stage, source) and errors by (stage, error type) in long form, from one
    grouping of the log."""
    base = log.groupBy("stage", "source", "error_type").agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("n")
    )
    entries = F.array_compact(
        F.array(
            F.struct(
                F.lit("records_processed").alias("metric"),
                F.col("stage"),
                F.col("source").alias("label"),
                F.col("records").alias("value"),
            ),
            F.when(
                F.col("error_type").isNotNull(),
                F.struct(
                    F.lit("errors").alias("metric"),
                    F.col("stage"),
                    F.col("error_type").alias("label"),
                    F.col("n").alias("value"),
                ),
            ),
        )
    )
    return base.select(F.inline(entries)).groupBy("metric", "stage", "label").agg(F.sum("value").alias("value"))


def call_counters(calls: DataFrame) -> DataFrame:
    """Calls by (api, status)."""
    return calls.groupBy("api", "status").agg(F.count(F.lit(1)).alias("value"))


def histogram(df: DataFrame, label: str, value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative bucket counts (``le`` null means unbounded) with the series' sum and count."""
    measured = F.col(value)
    folded = df.groupBy(label).agg(
        *[F.count_if(measured <= bound).alias(f"b{i}") for i, bound in enumerate(bounds)],
        F.count(measured).alias("observations"),
        F.sum(measured).alias("total"),
    )
    buckets = [
        F.struct(F.lit(float(bound)).alias("le"), F.col(f"b{i}").alias("bucket_count"))
        for i, bound in enumerate(bounds)
    ]
    buckets.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("observations").alias("bucket_count")))
    return folded.select(label, "observations", "total", F.inline(F.array(*buckets)))


# -- recording -----------------------------------------------------------------------------------


class StageTimer:
    """Times driver-side steps and keeps one log row each, for appending to the run-log table."""

    def __init__(self, run_id: str):
        self.run_id = run_id
        self.rows: list[tuple] = []

    @contextmanager
    def stage(self, name: str, source: str = "batch") -> Iterator[dict]:
        """Yields a dict the step may fill with ``records``, byte counts, and ``error_type`` for a
        failure that did not stop it."""
        facts: dict = {}
        begun, clock, error = datetime.now(timezone.utc), time.monotonic(), None
        try:
            yield facts
        except Exception as failure:
            error = type(failure).__name__
            raise
        finally:
            self.rows.append(
                (
                    self.run_id,
                    name,
                    begun,
                    time.monotonic() - clock,
                    facts.get("records"),
                    source,
                    error or facts.get("error_type"),
                    facts.get("bytes_written"),
                    facts.get("bytes_transferred"),
                )
            )

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, LOG_SCHEMA)

    def append(self, spark: SparkSession, path: str) -> str:
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)
        return path


def samples(df: DataFrame, labels: Sequence[str], at: str, value: Column, every: str) -> DataFrame:
    """Reduce raw rows to one metric sample per label and time bucket."""
    bucket = F.window(F.col(at), every)
    folded = df.groupBy(*refs(labels), bucket.alias("w")).agg(value.alias("value"))
    return folded.select(*refs(labels), F.col("w.end").alias("at"), "value")
