"""Structured Streaming queries over message envelopes made from all events."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake import schemas
from carelake.columns import refs
from carelake.operators import alerts, runlog
from carelake.plans import inputs, staging
from carelake.plans.inputs import VITALS_SQL
from carelake.plans.ops_queries import _RATE_LIMIT as RATE_LIMIT
from carelake.plans.registry import CHECKS, register, rounded
from carelake.session import fresh_path
from carelake.sources.tables import VersionedTable
from carelake.sources.writers import LakeLayout
from carelake.streaming import alert_spans, envelopes, progress, sinks, windows


def _messages(spark, path):
    """The envelopes below a folder as a stream."""
    schema = spark.read.parquet(path).schema
    return envelopes.read_files(spark, path, schema)


_PARSED = (
    "SELECT patient_id, cpf, nome, blood_pressure, heart_rate, temperatura, saturacao_o2, diagnostico, "
    f"NULL::VARCHAR AS estado, event_time, event_time AS kafka_timestamp FROM ({VITALS_SQL})"
)
_PARSED_COLUMNS = (
    "patient_id", "cpf", "nome", "blood_pressure", "heart_rate", "temperatura", "saturacao_o2", "diagnostico", "estado",
    "event_time", "kafka_timestamp",
)


@register("envelope_parse", _PARSED)
def _(spark, sf_dir):
    """Envelopes through a parsing stream into a Parquet sink."""
    out, marks = fresh_path(spark, "parsed"), fresh_path(spark, "checkpoints")
    rows = envelopes.parse(_messages(spark, staging.vital_messages(spark, sf_dir)))
    sinks.drain(sinks.append_rows(rows, out, marks, "parsed", every=None))
    return spark.read.parquet(out).select(*refs(_PARSED_COLUMNS))


@register(
    "envelope_simple",
    "SELECT event_time, patient_id, cpf, nome, blood_pressure, heart_rate, temperatura, saturacao_o2, "
    f"strftime(event_time, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" FROM ({VITALS_SQL})",
)
def _(spark, sf_dir):
    return envelopes.parse_simple(spark.read.parquet(staging.vital_messages(spark, sf_dir)))


@register("stream_to_lake", f"SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS date, count(*) AS events FROM ({VITALS_SQL}) GROUP BY 1")
def _(spark, sf_dir):
    layout = LakeLayout(fresh_path(spark, "streamed"))
    rows = envelopes.parse(_messages(spark, staging.vital_messages(spark, sf_dir)))
    dated = rows.withColumn("date", F.to_date("event_time"))
    sinks.drain(sinks.append_layer(dated, layout, "silver", "vitals", every=None, partition_by=["date"]))
    stored = spark.read.parquet(layout.path("silver", "vitals"))
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("events"))


@register(
    "batch_and_stream",
    f"SELECT patient_id, heart_rate FROM ({inputs.ENC_SQL}) UNION ALL SELECT patient_id, heart_rate FROM ({VITALS_SQL})",
)
def _(spark, sf_dir):
    out, marks = fresh_path(spark, "landed"), fresh_path(spark, "checkpoints")
    rows = envelopes.parse(_messages(spark, staging.vital_messages(spark, sf_dir)))
    sinks.drain(sinks.append_rows(rows, out, marks, "landed", every=None))
    stored = inputs.encounters(spark, sf_dir).drop("timestamp")
    return sinks.with_stream(spark, stored, out).select("patient_id", "heart_rate")


# -- sliding windows -------------------------------------------------------------------------------

_SLIDING = (
    "SELECT make_timestamp((pane - k * 60) * 1000000) AS window_start, make_timestamp((pane - k * 60 + 300) * 1000000) AS window_end, "
    "diagnostico, count(*) AS total_eventos, round(avg(heart_rate), 4) AS media_freq_cardiaca, "
    "round(avg(temperatura), 4) AS media_temperatura, min(saturacao_o2) AS min_saturacao FROM (SELECT *, "
    "CAST(floor(epoch(event_time) / 60) AS BIGINT) * 60 AS pane, unnest([0, 1, 2, 3, 4]) AS k "
    f"FROM ({VITALS_SQL})) GROUP BY pane - k * 60, diagnostico"
)
_CLOSED = f"SELECT * FROM ({_SLIDING}) WHERE window_end <= (SELECT max(event_time) FROM ({VITALS_SQL})) - INTERVAL 10 MINUTE"


def _flat(windowed):
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return rounded(windowed.select(*bounds, *[c for c in windowed.columns if c != "window"]))


@register("sliding_window_batch", _SLIDING)
def _(spark, sf_dir):
    rows = envelopes.parse(spark.read.parquet(staging.vital_messages(spark, sf_dir)), watermark=None)
    return _flat(windows.sliding_batch(rows))


@register("sliding_window_stream", _CLOSED)
def _(spark, sf_dir):
    """Append mode: a window is written once the watermark has passed its end."""
    out, marks = fresh_path(spark, "windows"), fresh_path(spark, "checkpoints")
    rows = envelopes.parse(_messages(spark, staging.vital_messages(spark, sf_dir)))
    sinks.drain(sinks.append_rows(windows.sliding_panes(rows), out, marks, "windows", every=None))
    return _flat(spark.read.parquet(out))


@register("sliding_window_complete", _SLIDING)
def _(spark, sf_dir):
    """Complete mode: every trigger replaces the stored result."""
    out, marks = fresh_path(spark, "replaced"), fresh_path(spark, "checkpoints")
    rows = envelopes.parse(_messages(spark, staging.vital_messages(spark, sf_dir)))
    for _ in range(2):  # the second run finds nothing new and goes on from the first
        sinks.drain(sinks.replace_result(windows.sliding(rows), out, marks, "windows", every=None))
    return _flat(VersionedTable(spark, out).read())


@register("late_rows", _CLOSED)
def _(spark, sf_dir):
    """The same messages once more, an hour late: all behind the watermark, none is counted."""
    arriving, out, marks = (fresh_path(spark, kind) for kind in ("arriving", "ontime", "checkpoints"))
    stored = spark.read.parquet(staging.vital_messages(spark, sf_dir))
    stored.write.parquet(arriving)
    schema = stored.schema

    def run_once():
        rows = envelopes.parse(envelopes.read_files(spark, arriving, schema))
        sinks.drain(sinks.append_rows(windows.sliding(rows), out, marks, "windows", every=None))

    run_once()
    hour = F.expr("INTERVAL 1 HOUR")
    payload = F.from_json(F.col("value").cast("string"), schemas.ENCOUNTER)
    late = stored.select(payload.alias("p")).select("p.*")
    shifted = F.date_format(F.col("timestamp").cast("timestamp") - hour, "yyyy-MM-dd HH:mm:ss")
    envelopes.wrap(late.withColumn("timestamp", shifted), "timestamp").write.mode("append").parquet(arriving)
    run_once()
    return _flat(spark.read.parquet(out))


# -- what running streams say of themselves --------------------------------------------------------

_BATCHES = 6


def _watched(spark, sf_dir):
    """Events land in six files of five days each; a watched stream reads a file in each batch."""
    landing, out, marks, log = (fresh_path(spark, kind) for kind in ("arriving", "watched", "checkpoints", "progress"))
    events = inputs.events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    slot = F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(_BATCHES - 1))
    for batch in range(_BATCHES):
        events.where(slot == batch).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    with progress.ProgressTable(spark, log, {"events"}) as watched:
        writer = stream.withWatermark("ts", "10 minutes").writeStream.queryName("events").format("parquet")
        query = writer.option("checkpointLocation", f"{marks}/events").trigger(availableNow=True).start(out)
        watched.drained(query)
    return watched.rows()


_SLOTS = (
    f"SELECT least((day(ts) - 1) // 5, {_BATCHES - 1}) AS batch, count(*) AS rows, date_trunc('milliseconds', max(ts)) AS newest FROM events GROUP BY 1"
)


@register(
    "stream_progress",
    f"SELECT 'events' AS query, range AS batch, coalesce(rows, 0) AS rows, newest FROM range({_BATCHES}) LEFT JOIN ({_SLOTS}) s ON s.batch = range",
)
def _(spark, sf_dir):
    return _watched(spark, sf_dir).select("query", "batch", "rows", "newest")


@register(
    "alert_running_stream_lag",
    f"""SELECT 'events' AS query, newest AS quiet_from, next AS quiet_to, round(epoch_us(next) / 1e6 - epoch_us(newest) / 1e6, 3) AS gap_seconds
    FROM (SELECT newest, coalesce(lead(newest) OVER (ORDER BY newest), TIMESTAMP '{inputs.EVENTS_AS_OF}') AS next FROM ({_SLOTS}))
    WHERE epoch_us(next) - epoch_us(newest) > 600 * 1000000""",
)
def _(spark, sf_dir):
    """The rule for streams that lag, over the table that a listener has written."""
    until = F.lit(inputs.EVENTS_AS_OF).cast("timestamp")
    spans = alerts.lag_held(_watched(spark, sf_dir).where("newest IS NOT NULL"), "query", "newest", until=until)
    times = [F.timestamp_micros(c).alias(c) for c in ("quiet_from", "quiet_to")]
    return rounded(spans.select("query", *times, "gap_seconds"), 3)


# -- alerts with a hold time -----------------------------------------------------------------------


def _streamed(spark, frame):
    """The rows of a frame, stored, as a stream."""
    path = fresh_path(spark, "arriving")
    frame.write.parquet(path)
    return spark.readStream.schema(frame.schema).parquet(path)


def _landed(spark, spans, name):
    out, marks = fresh_path(spark, name), fresh_path(spark, "checkpoints")
    sinks.drain(sinks.append_rows(spans, out, marks, name, every=None))
    return spark.read.schema(spans.schema).parquet(out)


_ERROR_TIMES = f"SELECT max(started) FROM ({inputs.LOG_SQL}) WHERE error_type IS NOT NULL"


@register(
    "alert_error_rate_stream",
    f"SELECT * FROM ({CHECKS['alert_error_rate']}) WHERE (\"until\" + 90) * 1000000 - 1 <= 1000 * epoch_ms(({_ERROR_TIMES})) - 600 * 1000000",
)
def _(spark, sf_dir):
    """The spans of the batch rule that the watermark, ten minutes behind, has passed."""
    errors = _streamed(spark, inputs.stage_log(spark, sf_dir).where(F.col("error_type").isNotNull()))
    errors = errors.withWatermark("started", "10 minutes")
    return _landed(spark, alert_spans.error_rate(errors, ["stage"], "started", limit_per_second=RATE_LIMIT), "error-spans")


_DAY = 86_400
_DAYS = f"SELECT stage, (epoch_us(date_trunc('day', started)) // 1000000) + {_DAY} AS tick, sum(duration) AS value FROM ({inputs.LOG_SQL}) GROUP BY ALL"


@register(
    "alert_stage_timeout_stream",
    f"SELECT * FROM ({CHECKS['alert_stage_timeout_held']}) WHERE \"until\" + {_DAY * 3 // 2} <= (SELECT max(tick) - 600 FROM ({_DAYS}))",
)
def _(spark, sf_dir):
    daily = runlog.samples(inputs.stage_log(spark, sf_dir), ["stage"], "started", F.sum("duration"), "1 day")
    samples = _streamed(spark, daily).withWatermark("at", "10 minutes")
    return _landed(spark, alert_spans.gauge_held(samples, ["stage"], fx.STAGE_TIMEOUT_SECONDS, _DAY, _DAY), "timeout-spans")
