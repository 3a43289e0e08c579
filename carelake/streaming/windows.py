"""Sliding-window aggregates, the same result from a stream and from a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.columns import ref


def sliding(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    by: str = "diagnostico",
    at: str = "event_time",
) -> DataFrame:
    """Per window and group: events, mean heart rate, mean temperature, lowest saturation.

    Partial aggregation runs before the exchange into the state store, so a hot group arrives as
    one row per window and task.
    """
    return events.groupBy(F.window(ref(at), window, slide), ref(by)).agg(
        F.count(F.lit(1)).alias("total_eventos"),
        F.mean("heart_rate").alias("media_freq_cardiaca"),
        F.mean("temperatura").alias("media_temperatura"),
        F.min("saturacao_o2").alias("min_saturacao"),
    )


def sliding_panes(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    by: str = "diagnostico",
    at: str = "event_time",
) -> DataFrame:
    """``sliding`` for a watermarked stream in append mode, through panes of one slide: events are
    not copied to the windows they are in, only their panes are. A late event counts until its pane
    is closed, and then in all of its windows."""
    panes = events.groupBy(F.window(ref(at), slide), ref(by)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("heart_rate").cast("double")).alias("hr"),
        F.count("heart_rate").alias("hr_n"),
        F.sum("temperatura").alias("temp"),
        F.count("temperatura").alias("temp_n"),
        F.min("saturacao_o2").alias("low"),
    )
    return panes.groupBy(F.window(F.window_time("window"), window, slide), ref(by)).agg(
        F.sum("n").alias("total_eventos"),
        F.try_divide(F.sum("hr"), F.sum("hr_n")).alias("media_freq_cardiaca"),
        F.try_divide(F.sum("temp"), F.sum("temp_n")).alias("media_temperatura"),
        F.min("low").alias("min_saturacao"),
    )


def sliding_batch(
    events: DataFrame,
    window_seconds: int = 300,
    slide_seconds: int = 60,
    by: str = "diagnostico",
    at: str = "event_time",
) -> DataFrame:
    """``sliding`` for stored data, through panes.

    A sliding window copies each event once per overlapping window before aggregating. Here events
    are first folded into panes of one slide, and only the panes are copied, so the volume that is
    multiplied depends on time and groups, not on events.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    pane = F.floor(F.unix_seconds(ref(at).cast("timestamp")) / slide_seconds) * slide_seconds
    panes = events.where(ref(at).isNotNull()).groupBy(ref(by), pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("heart_rate").cast("double")).alias("hr"),
        F.count("heart_rate").alias("hr_n"),
        F.sum("temperatura").alias("temp"),
        F.count("temperatura").alias("temp_n"),
        F.min("saturacao_o2").alias("low"),
    )
    back = F.explode(F.array(*[F.lit(i * slide_seconds) for i in range(window_seconds // slide_seconds)]))
    spread = panes.select("*", back.alias("back")).withColumn("start", F.col("pane") - F.col("back"))
    folded = spread.groupBy("start", ref(by)).agg(
        F.sum("n").alias("total_eventos"),
        F.try_divide(F.sum("hr"), F.sum("hr_n")).alias("media_freq_cardiaca"),
        F.try_divide(F.sum("temp"), F.sum("temp_n")).alias("media_temperatura"),
        F.min("low").alias("min_saturacao"),
    )
    span = F.struct(
        F.timestamp_seconds("start").alias("start"),
        F.timestamp_seconds(F.col("start") + window_seconds).alias("end"),
    )
    return folded.select(span.alias("window"), *[c for c in folded.columns if c != "start"])
