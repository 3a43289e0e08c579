"""Alert rules as queries over metric tables.

Rules that need an order in time never sort raw rows: events are first counted into fixed panes
per label, so what a window function sees of a label is bounded by elapsed time, not by volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from carelake import fixed_values as fx
from carelake.columns import instant, ref, refs


def slow_stages(profile: DataFrame, limit_seconds: float = fx.STAGE_TIMEOUT_SECONDS) -> DataFrame:
    return profile.where(F.col("duration_seconds") > limit_seconds)


def high_nulls(gauge: DataFrame, limit: float = fx.NULL_ALERT_RATIO) -> DataFrame:
    return gauge.where((F.col("metric") == "null_ratio") & (F.col("value") > limit)).drop("metric")


def high_duplicates(gauge: DataFrame, limit: float = fx.DUPLICATE_ALERT_RATIO) -> DataFrame:
    return gauge.where((F.col("metric") == "duplicate_ratio") & (F.col("value") > limit)).select("layer", "value")


def stream_lag(events: DataFrame, query: str, event_time: str, as_of=None) -> DataFrame:
    """Seconds between the reference instant and the newest event of each query."""
    newest = F.max(ref(event_time)).cast("timestamp")
    age = (F.unix_micros(instant(as_of)) - F.unix_micros(newest)) / F.lit(1_000_000.0)
    return events.groupBy(ref(query).alias("query")).agg(age.alias("lag_seconds"))


def lagging_streams(lags: DataFrame, limit_seconds: float = fx.STREAM_LAG_SECONDS) -> DataFrame:
    return lags.where(F.col("lag_seconds") > limit_seconds)


def held(evaluations: DataFrame, labels: Sequence[str], step_seconds: int, hold_seconds: int) -> DataFrame:
    """Spans over which a condition was true at every evaluation for at least ``hold_seconds``.

    ``evaluations`` holds the label columns and ``tick`` (epoch seconds, multiples of the step) of
    every evaluation at which the condition held. Neighbouring ticks belong to one span.
    """
    order = W.partitionBy(*refs(labels)).orderBy("tick")
    island = F.col("tick") - F.row_number().over(order) * step_seconds
    spans = (
        evaluations.withColumn("island", island)
        .groupBy(*refs(labels), "island")
        .agg(F.min("tick").alias("since"), F.max("tick").alias("until"), F.count(F.lit(1)).alias("evaluations"))
    )
    return spans.where(F.col("until") - F.col("since") >= hold_seconds).drop("island")


def gauge_held(
    samples: DataFrame, labels: Sequence[str], limit: float, step_seconds: int, hold_seconds: int
) -> DataFrame:
    """Spans over which a sampled gauge (``at``, ``value`` per label) stayed above its limit."""
    above = samples.where(F.col("value") > limit)
    ticks = above.select(*refs(labels), F.unix_seconds(F.col("at").cast("timestamp")).alias("tick"))
    return held(ticks, labels, step_seconds, hold_seconds)


def lag_held(
    events: DataFrame,
    query: str,
    event_time: str,
    limit_seconds: int = fx.STREAM_LAG_SECONDS,
    hold_seconds: int = 300,
    until: Column | None = None,
) -> DataFrame:
    """Spans in which a stream's lag stayed above the limit for the hold time. The lag exceeds the
    limit from that long after an event until the next one, so this is a rule about gaps."""
    return idle_spans(events, [query], event_time, limit_seconds, hold_seconds, until)


def trailing_counts(
    events: DataFrame, labels: Sequence[str], at: str, span_seconds: int, step_seconds: int = 60
) -> DataFrame:
    """Events of the last ``span_seconds`` at every step, per label.

    Events are counted per step first (map-side combined); the few panes, not the events, are then
    copied to the evaluations they take part in. The span must be whole steps.
    """
    if span_seconds % step_seconds:
        raise ValueError("the span must be a multiple of the step")
    panes = span_seconds // step_seconds
    epoch = F.unix_seconds(ref(at).cast("timestamp"))
    pane_end = F.floor(epoch / step_seconds) * step_seconds + step_seconds
    counted = events.groupBy(*refs(labels), pane_end.alias("pane")).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.explode(F.array(*[F.lit(i * step_seconds) for i in range(panes)]))
    spread = counted.select(*refs(labels), "pane", "n", ahead.alias("ahead"))
    return spread.groupBy(*refs(labels), (F.col("pane") + F.col("ahead")).alias("tick")).agg(F.sum("n").alias("n"))


def error_rate(
    errors: DataFrame,
    labels: Sequence[str],
    at: str,
    limit_per_second: float = fx.ERROR_RATE_PER_SECOND,
    span_seconds: int = 300,
    hold_seconds: int = 120,
    step_seconds: int = 60,
) -> DataFrame:
    """Spans in which the trailing error rate stayed above the limit, evaluated at each step."""
    rate = F.col("n") / F.lit(float(span_seconds))
    above = trailing_counts(errors, labels, at, span_seconds, step_seconds).where(rate > limit_per_second)
    return held(above, labels, step_seconds, hold_seconds)


def idle_spans(
    events: DataFrame,
    labels: Sequence[str],
    at: str,
    window_seconds: int = 600,
    hold_seconds: int = 900,
    until: Column | None = None,
) -> DataFrame:
    """Gaps between records so long that a trailing window was empty for the hold time.

    The window is empty from ``window_seconds`` after a record on, so the rule fires for gaps above
    their sum. Only first and last instants per window-sized pane are compared: a gap inside a pane
    is shorter than the window and cannot fire. ``until`` closes the last, open gap of each label.
    """
    micros = F.unix_micros(ref(at).cast("timestamp"))
    pane = F.floor(micros / F.lit(window_seconds * 1_000_000))
    panes = events.groupBy(*refs(labels), pane.alias("pane")).agg(
        F.min(micros).alias("first"), F.max(micros).alias("last")
    )
    order = W.partitionBy(*refs(labels)).orderBy("pane")
    closing = F.lead("first").over(order)
    if until is not None:
        closing = F.coalesce(closing, F.unix_micros(until))
    gaps = panes.select(*refs(labels), F.col("last").alias("quiet_from"), closing.alias("quiet_to"))
    limit = (window_seconds + hold_seconds) * 1_000_000
    gap = F.col("quiet_to") - F.col("quiet_from")
    return gaps.where(gap > limit).select(
        *refs(labels), "quiet_from", "quiet_to", (gap / F.lit(1_000_000.0)).alias("gap_seconds")
    )
