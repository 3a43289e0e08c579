"""Alert rules with a hold time on streams: the spans of ``operators.alerts``, written as they end.

Evaluations at which a condition holds, one a step, are events of their own; those that follow each
other at one step are one session, whose first and last tell how long the condition held. A span is
written once the watermark has passed the step after its last evaluation, in append mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import ref, refs


def held(evaluations: DataFrame, labels: Sequence[str], seen: str, tick: Column, step_seconds: int, hold_seconds: int) -> DataFrame:
    """Spans of evaluations that hold. ``seen`` is their watermarked time, ``tick`` the epoch second of
    the evaluation; a session goes on where the next one is less than two steps away."""
    if step_seconds < 2:
        raise ValueError("a step must be two seconds or more")
    span = F.session_window(ref(seen), f"{step_seconds + step_seconds // 2} seconds")
    spans = evaluations.groupBy(*refs(labels), span).agg(
        F.min(tick).alias("since"), F.max(tick).alias("until"), F.count(F.lit(1)).alias("evaluations")
    )
    return spans.where(F.col("until") - F.col("since") >= hold_seconds).drop("session_window")


def gauge_held(samples: DataFrame, labels: Sequence[str], limit: float, step_seconds: int, hold_seconds: int) -> DataFrame:
    """Spans over which a sampled gauge (``at``, ``value`` per label, watermarked on ``at``) stayed
    above its limit: null ratios, stage times, lags."""
    above = samples.where(F.col("value") > limit)
    return held(above, labels, "at", F.unix_seconds("at"), step_seconds, hold_seconds)


def error_rate(
    errors: DataFrame,
    labels: Sequence[str],
    at: str,
    limit_per_second: float = fx.ERROR_RATE_PER_SECOND,
    span_seconds: int = 300,
    hold_seconds: int = 120,
    step_seconds: int = 60,
) -> DataFrame:
    """Spans in which the trailing error rate of a stream, watermarked on ``at``, stayed above the limit."""
    trailing = F.window(ref(at), f"{span_seconds} seconds", f"{step_seconds} seconds")
    counted = errors.groupBy(*refs(labels), trailing).agg(F.count(F.lit(1)).alias("n"))
    above = counted.where(F.col("n") / F.lit(float(span_seconds)) > limit_per_second)
    ticks = above.select(*refs(labels), F.window_time("window").alias("seen"), F.unix_seconds("window.end").alias("tick"))
    return held(ticks, labels, "seen", F.col("tick"), step_seconds, hold_seconds)
