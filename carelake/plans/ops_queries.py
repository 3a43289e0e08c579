"""Run-log analytics and alert rules over events seen as a stage log."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.operators import alerts, quality, runlog
from carelake.plans import inputs
from carelake.plans.inputs import ENC_SQL, LOG_SQL
from carelake.plans.registry import register, rounded

_STAGES = (
    "SELECT run_id, stage, sum(duration) AS duration, sum(records)::BIGINT AS records, min(started) AS started "
    f"FROM ({LOG_SQL}) GROUP BY run_id, stage"
)
_PROFILE = (
    "SELECT run_id, stage, round(duration, 3) AS duration_seconds, records, "
    "round(records / greatest(duration, 0.001), 2) AS records_per_second, "
    "round(duration / greatest(sum(duration) OVER (PARTITION BY run_id), 0.001) * 100, 1) AS pct_of_total "
    f"FROM ({_STAGES})"
)


@register("stage_profile", _PROFILE)
def _(spark, sf_dir):
    return runlog.stage_profile(inputs.stage_log(spark, sf_dir))


@register(
    "run_bottleneck",
    "SELECT run_id, round(sum(duration), 3) AS total_duration_seconds, "
    "round(sum(records) / greatest(sum(duration), 0.001), 2) AS records_per_second, "
    "coalesce(first(stage ORDER BY duration DESC, started) FILTER (duration > 0), '') AS bottleneck_stage "
    f"FROM ({_STAGES}) GROUP BY run_id",
)
def _(spark, sf_dir):
    return runlog.run_report(inputs.stage_log(spark, sf_dir))


@register(
    "stage_timing",
    f"SELECT run_id, stage, round(sum(duration), 4) AS seconds FROM ({LOG_SQL}) GROUP BY run_id, stage "
    f"UNION ALL SELECT run_id, NULL, round(sum(duration), 4) FROM ({LOG_SQL}) GROUP BY run_id",
)
def _(spark, sf_dir):
    return rounded(runlog.stage_timing(inputs.stage_log(spark, sf_dir)))


@register("stage_latency", f"SELECT stage, round(avg(duration), 6) AS avg_latency FROM ({LOG_SQL}) GROUP BY stage")
def _(spark, sf_dir):
    return rounded(runlog.stage_latency(inputs.stage_log(spark, sf_dir)), 6)


_ITEMS = {
    "compute_cost_usd": "hours * 2 * 0.126",
    "storage_cost_usd": "gb * 0.023 / 30",
    "request_cost_usd": "records_processed / 1000 * 0.005",
    "transfer_cost_usd": "moved * 0.09",
    "broker_cost_usd": "0.21 * hours * 3",
    "database_cost_usd": "0.068 * hours",
}


def _cost_sql(items):
    total = " + ".join(items)
    return (
        f"SELECT *, round({total}, 4) AS total_cost_usd, round(({total}) / greatest(records_processed, 1), 8) AS cost_per_record_usd "
        "FROM (SELECT run_id, records_processed, "
        + ", ".join(f"round({_ITEMS[i]}, 4) AS {i}" for i in items)
        + " FROM (SELECT run_id, sum(duration) / 3600 AS hours, sum(records)::BIGINT AS records_processed, "
        "sum(bytes_written) / 1073741824.0::DOUBLE AS gb, sum(bytes_transferred) / 1073741824.0::DOUBLE AS moved "
        f"FROM ({LOG_SQL}) GROUP BY run_id))"
    )


@register("run_cost", _cost_sql(list(_ITEMS)))
def _(spark, sf_dir):
    return runlog.run_cost(inputs.stage_log(spark, sf_dir))


@register("run_cost_core_only", _cost_sql(list(_ITEMS)[:4]))
def _(spark, sf_dir):
    return runlog.run_cost(inputs.stage_log(spark, sf_dir), include_broker=False, include_database=False)


@register(
    "counters",
    f"SELECT 'records_processed' AS metric, stage, source AS label, sum(records)::BIGINT AS value FROM ({LOG_SQL}) GROUP BY 2, 3 "
    f"UNION ALL SELECT 'errors', stage, error_type, count(*) FROM ({LOG_SQL}) WHERE error_type IS NOT NULL GROUP BY 2, 3",
)
def _(spark, sf_dir):
    return runlog.counters(inputs.stage_log(spark, sf_dir))


@register(
    "call_counters",
    f"SELECT source AS api, coalesce(error_type, 'ok') AS status, count(*) AS value FROM ({LOG_SQL}) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    status = F.coalesce("error_type", F.lit("ok")).alias("status")
    return runlog.call_counters(inputs.stage_log(spark, sf_dir).select(F.col("source").alias("api"), status))


def _histogram_sql(source, label, value, bounds):
    rows = ", ".join(f"({float(b)}::DOUBLE)" for b in bounds)
    return (
        f"WITH src AS ({source}), bounds AS (SELECT * FROM (VALUES {rows}, (NULL)) b(le)) "
        f"SELECT {label}, observations, round(total, 2) AS total, le, "
        f"(SELECT count(*) FROM src s WHERE s.{label} = t.{label} AND (le IS NULL OR s.{value} <= le)) AS bucket_count "
        f"FROM (SELECT {label}, count({value}) AS observations, sum({value})::DOUBLE AS total FROM src GROUP BY 1) t, bounds"
    )


@register("duration_histogram", _histogram_sql(LOG_SQL, "stage", "duration", fx.DURATION_BOUNDS))
def _(spark, sf_dir):
    log = inputs.stage_log(spark, sf_dir)
    return rounded(runlog.histogram(log, "stage", "duration", fx.DURATION_BOUNDS), 2)


@register(
    "record_size_histogram",
    _histogram_sql(
        "SELECT lang AS layer, octet_length(encode(text)) AS size FROM documents", "layer", "size", fx.RECORD_SIZE_BOUNDS
    ),
)
def _(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    sized = docs.select(F.col("lang").alias("layer"), F.octet_length("text").cast("double").alias("size"))
    return rounded(runlog.histogram(sized, "layer", "size", fx.RECORD_SIZE_BOUNDS), 2)


# -- alert rules -----------------------------------------------------------------------------------


@register("alert_stage_timeout", f"SELECT * FROM ({_PROFILE}) WHERE duration_seconds > 600")
def _(spark, sf_dir):
    return alerts.slow_stages(runlog.stage_profile(inputs.stage_log(spark, sf_dir)))


_RATE_LIMIT = 0.004
_TRAILING = (
    "SELECT stage, pane + k * 60 AS tick, sum(n) AS n FROM (SELECT stage, CAST(floor(epoch(started) / 60) AS BIGINT) * 60 + 60 AS pane, "
    f"count(*) AS n, unnest([0, 1, 2, 3, 4]) AS k FROM ({LOG_SQL}) WHERE error_type IS NOT NULL GROUP BY stage, pane) "
    "GROUP BY stage, tick"
)


@register(
    "alert_error_rate",
    'SELECT stage, min(tick) AS since, max(tick) AS "until", count(*) AS evaluations FROM (SELECT *, tick - 60 * row_number() '
    f"OVER (PARTITION BY stage ORDER BY tick) AS island FROM ({_TRAILING}) WHERE n / 300.0::DOUBLE > {_RATE_LIMIT}) "
    "GROUP BY stage, island HAVING max(tick) - min(tick) >= 120",
)
def _(spark, sf_dir):
    errors = inputs.stage_log(spark, sf_dir).where(F.col("error_type").isNotNull())
    return alerts.error_rate(errors, ["stage"], "started", limit_per_second=_RATE_LIMIT)


@register(
    "trailing_error_counts", _TRAILING.replace("sum(n) AS n", "sum(n)::BIGINT AS n")
)
def _(spark, sf_dir):
    errors = inputs.stage_log(spark, sf_dir).where(F.col("error_type").isNotNull())
    return alerts.trailing_counts(errors, ["stage"], "started", 300)


@register(
    "alert_null_ratio",
    "SELECT 'bronze' AS layer, 'medicamento' AS \"column\", round(count(*) FILTER (medicamento IS NULL) / count(*), 6) AS value "
    f"FROM ({ENC_SQL}) HAVING value > 0.3",
)
def _(spark, sf_dir):
    gauge = quality.gauges({"bronze": inputs.encounters(spark, sf_dir)})
    return rounded(alerts.high_nulls(gauge), 6)


@register(
    "alert_duplicate_ratio",
    f"WITH c AS (SELECT (SELECT count(*) FROM ({ENC_SQL})) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({ENC_SQL}))) AS d), "
    "shares AS (SELECT 'bronze' AS layer, 1 - d / n AS value FROM c UNION ALL SELECT 'twice', 1 - d / (2 * n) FROM c) "
    "SELECT layer, round(value, 6) AS value FROM shares WHERE value > 0.05",
)
def _(spark, sf_dir):
    """All encounters, whose copies stay below the limit, and all of them landed twice."""
    rows = inputs.encounters(spark, sf_dir)
    return rounded(alerts.high_duplicates(quality.gauges({"bronze": rows, "twice": rows.unionAll(rows)})), 6)


_LAG = (
    "SELECT event_type AS query, round(epoch_us(TIMESTAMP '{t}') / 1e6 - epoch_us(max(ts)) / 1e6, 3) AS lag_seconds "
    "FROM events GROUP BY event_type"
).format(t=inputs.EVENTS_AS_OF)


@register("stream_lag", _LAG)
def _(spark, sf_dir):
    return rounded(alerts.stream_lag(inputs.events(spark, sf_dir), "event_type", "ts", inputs.EVENTS_AS_OF), 3)


@register("alert_stream_lag", f"SELECT * FROM ({_LAG}) WHERE lag_seconds > 300")
def _(spark, sf_dir):
    lags = alerts.stream_lag(inputs.events(spark, sf_dir), "event_type", "ts", inputs.EVENTS_AS_OF)
    return rounded(alerts.lagging_streams(lags), 3)


def _gap_sql(limit):
    return (
        "SELECT stage, epoch_us(started) AS quiet_from, epoch_us(next) AS quiet_to, "
        "round((epoch_us(next) - epoch_us(started)) / 1e6, 3) AS gap_seconds FROM (SELECT stage, started, coalesce(lead(started) OVER "
        f"(PARTITION BY stage ORDER BY started), TIMESTAMP '{inputs.EVENTS_AS_OF}') AS next FROM ({LOG_SQL})) "
        f"WHERE epoch_us(next) - epoch_us(started) > {limit} * 1000000"
    )


@register("alert_idle_stage", _gap_sql(1500))
def _(spark, sf_dir):
    now = F.lit(inputs.EVENTS_AS_OF).cast("timestamp")
    return rounded(alerts.idle_spans(inputs.stage_log(spark, sf_dir), ["stage"], "started", until=now), 3)


@register(
    "metric_samples",
    "SELECT stage, date_trunc('hour', started) + INTERVAL 1 HOUR AS at, round(avg(duration), 6) AS value "
    f"FROM ({LOG_SQL}) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    log = inputs.stage_log(spark, sf_dir)
    return rounded(runlog.samples(log, ["stage"], "started", F.mean("duration"), "1 hour"), 6)


@register("alert_stream_lag_held", _gap_sql(600))
def _(spark, sf_dir):
    now = F.lit(inputs.EVENTS_AS_OF).cast("timestamp")
    return rounded(alerts.lag_held(inputs.stage_log(spark, sf_dir), "stage", "started", until=now), 3)


_DAY = 86_400


def _held_sql(samples, label, limit, hold):
    return (
        f"SELECT {label}, min(tick) AS since, max(tick) AS \"until\", count(*) AS evaluations FROM (SELECT *, tick - {_DAY} * "
        f"row_number() OVER (PARTITION BY {label} ORDER BY tick) AS island FROM ({samples}) WHERE value > {limit}) "
        f"GROUP BY {label}, island HAVING max(tick) - min(tick) >= {hold}"
    )


@register(
    "alert_null_ratio_held",
    _held_sql(
        "SELECT sexo, CAST(epoch(date_trunc('day', \"timestamp\")) AS BIGINT) + 86400 AS tick, "
        f"avg((medicamento IS NULL)::INT) AS value FROM ({ENC_SQL}) GROUP BY ALL",
        "sexo", fx.NULL_ALERT_RATIO, 2 * _DAY,
    ),
)
def _(spark, sf_dir):
    """Days in a row on which a third of the medications of a group is missing."""
    missing = F.mean(F.col("medicamento").isNull().cast("int"))
    daily = runlog.samples(inputs.encounters(spark, sf_dir), ["sexo"], "timestamp", missing, "1 day")
    return alerts.gauge_held(daily, ["sexo"], fx.NULL_ALERT_RATIO, _DAY, 2 * _DAY)


@register(
    "alert_stage_timeout_held",
    _held_sql(
        "SELECT stage, CAST(epoch(date_trunc('day', started)) AS BIGINT) + 86400 AS tick, sum(duration) AS value "
        f"FROM ({LOG_SQL}) GROUP BY ALL",
        "stage", fx.STAGE_TIMEOUT_SECONDS, _DAY,
    ),
)
def _(spark, sf_dir):
    daily = runlog.samples(inputs.stage_log(spark, sf_dir), ["stage"], "started", F.sum("duration"), "1 day")
    return alerts.gauge_held(daily, ["stage"], fx.STAGE_TIMEOUT_SECONDS, _DAY, _DAY)
