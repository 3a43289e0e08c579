import json
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.sources.tables import VersionedTable
from carelake.sources.writers import LakeLayout
from carelake.streaming import envelopes, sinks, windows
from helpers import at, rows

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(minute, diagnosis="x", rate=80, **more):
    body = {"patient_id": "p", "diagnostico": diagnosis, "heart_rate": rate, "temperatura": 36.5, "saturacao_o2": 95}
    body["timestamp"] = (START + timedelta(minutes=minute)).strftime("%Y-%m-%d %H:%M:%S")
    return json.dumps({**body, **more})


def arrive(spark, folder, *bodies):
    df = spark.createDataFrame([(b.encode(), START) for b in bodies], "value binary, timestamp timestamp")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def test_broker_options():
    options = envelopes.broker_options("h:9092", "events")
    assert options == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "events", "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    assert envelopes.broker_options("h", "t", max_offsets_per_trigger=9)["maxOffsetsPerTrigger"] == "9"


def test_parse_enforces_the_schema(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = arrive(spark, folder, message(1, extra="ignored"), "no json", message(2, rate="fast"))
    parsed = envelopes.parse(spark.read.schema(schema).parquet(folder))
    assert len(parsed.columns) == 18 and "extra" not in parsed.columns
    assert sorted(rows(parsed, "patient_id", "heart_rate", "event_time"), key=repr) == sorted(
        [("p", 80, at("2024-01-01 00:01:00")), (None, None, None), ("p", None, at("2024-01-01 00:02:00"))], key=repr
    )
    simple = envelopes.parse_simple(spark.read.schema(schema).parquet(folder))
    assert len(simple.columns) == 9 and set(rows(simple, "event_time")) == {(at("2024-01-01"),)}


def test_restart_adds_nothing(spark, tmp_path):
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    schema = arrive(spark, folder, message(1), message(2))

    def once():
        stream = envelopes.parse(envelopes.read_files(spark, folder, schema))
        sinks.drain(sinks.append_rows(stream, out, marks, "raw", every=None))
        return spark.read.parquet(out).count()

    assert once() == 2
    assert once() == 2
    arrive(spark, folder, message(3))
    assert once() == 3


def test_late_rows_are_dropped_in_append_mode_only(spark, tmp_path):
    folder, out, full, marks = (str(tmp_path / n) for n in ("in", "out", "full", "marks"))
    schema = arrive(spark, folder, message(0), message(60))

    def once():
        stream = envelopes.parse(envelopes.read_files(spark, folder, schema))
        sinks.drain(sinks.append_rows(windows.sliding(stream), out, marks, "append", every=None))
        sinks.drain(sinks.replace_result(windows.sliding(stream), full, marks, "complete", every=None))
        appended = spark.read.parquet(out).agg(F.sum("total_eventos")).first()[0]
        return appended, VersionedTable(spark, full).read().agg(F.sum("total_eventos")).first()[0]

    # one event counts in five windows; the windows of minute 60 are still open
    assert once() == (5, 10)
    arrive(spark, folder, message(1), message(80))
    # minute 1 is behind the watermark of minute 50: dropped by append mode, kept by complete mode
    assert once() == (10, 20)


def test_complete_result_is_versioned(spark, tmp_path):
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    schema = arrive(spark, folder, message(0))

    def once():
        stream = envelopes.parse(envelopes.read_files(spark, folder, schema))
        sinks.drain(sinks.replace_result(windows.sliding(stream), out, marks, "agg", every=None))

    once()
    arrive(spark, folder, message(0, "y"))
    once()
    table = VersionedTable(spark, out)
    versions = [r["version"] for r in table.history().collect()]
    assert len(versions) >= 2
    assert table.read(version=versions[-1]).count() == 5 and table.read().count() == 10


def test_complete_sink_restarts(spark, tmp_path):
    """After a crash between the table's commit and the batch's, and with a new checkpoint."""
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    schema = arrive(spark, folder, message(0))

    def once(name):
        stream = envelopes.parse(envelopes.read_files(spark, folder, schema))
        sinks.drain(sinks.replace_result(windows.sliding(stream), out, marks, name, every=None))
        return VersionedTable(spark, out)

    first = once("agg").latest()
    commits = sorted((tmp_path / "marks" / "agg" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for crc in (tmp_path / "marks" / "agg" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    commits[-1].unlink()
    again = once("agg")
    assert again.latest() == first and again.read().count() == 5
    arrive(spark, folder, message(0, "y"))
    assert once("agg").read().count() == 10
    fresh = once("anew")
    assert fresh.latest() > first and fresh.read().count() == 10


def test_layer_sink_keeps_a_checkpoint_per_table(spark, tmp_path):
    folder, layout = str(tmp_path / "in"), LakeLayout(str(tmp_path / "lake"))
    schema = arrive(spark, folder, message(0), message(24 * 60))
    for table in ("a", "b"):
        stream = envelopes.parse(envelopes.read_files(spark, folder, schema)).withColumn("date", F.to_date("event_time"))
        sinks.drain(sinks.append_layer(stream, layout, "silver", table, every=None, partition_by=["date"]))
        assert spark.read.parquet(layout.path("silver", table)).select("date").distinct().count() == 2
    assert {p.name for p in (tmp_path / "lake" / "checkpoints").iterdir()} == {"silver-a", "silver-b"}


def test_console_and_progress(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = arrive(spark, folder, message(5))
    stream = envelopes.parse(envelopes.read_files(spark, folder, schema))
    query = sinks.print_rows(stream, every=None)
    sinks.drain(query, timeout=60)
    lag = sinks.progress_lag_seconds(query, START + timedelta(minutes=15))
    # the watermark moves in a last batch without data, which reports no event time
    newest = [p["eventTime"]["max"] for p in query.recentProgress if "max" in p.get("eventTime", {})]
    assert query.exception() is None and (lag == 600.0 or newest)


def test_unreadable_stream_part_is_an_error(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a")], "k int, v string")
    (tmp_path / "empty").mkdir()
    assert rows(sinks.with_stream(spark, stored, str(tmp_path / "empty"))) == [(1, "a")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        sinks.with_stream(spark, stored, str(tmp_path / "bad")).count()


def test_batch_goes_on_without_the_stream(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(sinks.with_stream(spark, stored, str(tmp_path / "none"))) == [(1, "a")]
    spark.createDataFrame([(2,)], "k int").write.parquet(str(tmp_path / "landed"))
    assert set(rows(sinks.with_stream(spark, stored, str(tmp_path / "landed")))) == {(1, "a"), (2, None)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(
        st.tuples(st.integers(0, 1200), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(50, 130))),
        max_size=25,
    )
)
def test_panes_equal_windows(spark, events):
    """The pane form gives what the window function gives, also with one group that dominates."""
    data = [(START + timedelta(seconds=s), d, r, 36.5, r) for s, d, r in events]
    data += [(START + timedelta(seconds=i % 7), "hot", 80, 37.0, 90) for i in range(60)] + [(None, "a", 1, 1.0, 1)]
    df = spark.createDataFrame(
        data, "event_time timestamp, diagnostico string, heart_rate int, temperatura double, saturacao_o2 int"
    )
    columns = ("window.start", "window.end", "diagnostico", "total_eventos", "media_freq_cardiaca", "media_temperatura", "min_saturacao")
    got, want = (rows(f(df), *columns) for f in (windows.sliding_batch, windows.sliding))
    assert len(got) == len(want)
    for mine, theirs in zip(got, want):
        assert mine[:4] == theirs[:4] and mine[6] == theirs[6]
        assert mine[4:6] == pytest.approx(theirs[4:6])


def test_progress_of_streams_as_a_table(spark, tmp_path):
    from carelake.streaming import progress

    log, landing, marks = str(tmp_path / "log"), str(tmp_path / "in"), str(tmp_path / "marks")
    assert progress.read_progress(spark, log).count() == 0

    def run(name, rows_in):
        spark.createDataFrame(rows_in, "ts timestamp, v int").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("ts timestamp, v int").parquet(landing).withWatermark("ts", "1 minute")
        writer = stream.writeStream.queryName(name).format("parquet").option("checkpointLocation", f"{marks}/{name}")
        query = writer.trigger(availableNow=True).start(str(tmp_path / name))
        watched.drained(query)

    with progress.ProgressTable(spark, log, {"mine"}) as watched:
        run("mine", [(at("2024-01-01 10:00:00"), 1), (at("2024-01-01 09:00:00"), 2)])
        run("other", [(at("2024-01-05 10:00:00"), 1)])
        run("mine", [(at("2024-01-02 10:00:00"), 3)])
    seen = rows(watched.rows(), "query", "batch", "rows", "newest")
    assert seen == [("mine", 0, 2, at("2024-01-01 10:00:00")), ("mine", 1, 2, at("2024-01-05 10:00:00"))]
    # a batch that ran twice is there once
    again = spark.read.parquet(log).where("batch = 1").withColumns({"run": F.lit("second"), "at": F.col("at") + F.expr("INTERVAL 1 HOUR")})
    again.write.mode("append").parquet(log)
    assert rows(watched.rows().where("batch = 1"), "run") == [("second",)]
