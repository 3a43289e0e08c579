from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.operators import alerts, runlog
from helpers import at, rows

NO_FIXTURE_CHECK = [HealthCheck.function_scoped_fixture]


@pytest.fixture(scope="module")
def log(spark):
    data = [
        ("r1", "extract", at("2024-01-01 00:00:00"), 2.0, 100, "csv", None, 0, 0),
        ("r1", "load", at("2024-01-01 00:01:00"), 6.0, 50, "csv", None, 1024**3, 0),
        ("r1", "load", at("2024-01-01 00:02:00"), 0.0, 50, "json", "IOError", 0, 2 * 1024**3),
        ("r2", "extract", at("2024-01-02 00:00:00"), 0.0, 7, "csv", None, 0, 0),
    ]
    return spark.createDataFrame(data, runlog.LOG_SCHEMA)


def test_profile(log):
    assert rows(runlog.stage_profile(log)) == [
        ("r1", "extract", 2.0, 100, 50.0, 25.0),
        ("r1", "load", 6.0, 100, 16.67, 75.0),
        ("r2", "extract", 0.0, 7, 7000.0, 0.0),
    ]
    assert rows(runlog.run_report(log)) == [("r1", 8.0, 25.0, "load"), ("r2", 0.0, 7000.0, "")]
    assert set(rows(runlog.stage_timing(log))) == {
        ("r1", "extract", 2.0), ("r1", "load", 6.0), ("r1", None, 8.0), ("r2", "extract", 0.0), ("r2", None, 0.0),
    }
    assert rows(runlog.stage_latency(log)) == [("extract", 1.0), ("load", 3.0)]


def test_earliest_of_equal_stages_is_the_bottleneck(spark):
    data = [("r", s, at(t), 5.0, 1, None, None, 0, 0) for s, t in (("z", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:09"))]
    log = spark.createDataFrame(data, runlog.LOG_SCHEMA)
    assert runlog.run_report(log).first()["bottleneck_stage"] == "z"


def test_cost(spark):
    data = [("r", "s", at("2024-01-01"), 7200.0, 2000, None, None, 3 * 1024**3, 1024**3)]
    log = spark.createDataFrame(data, runlog.LOG_SCHEMA)
    got = runlog.run_cost(log).first().asDict()
    items = {
        "compute_cost_usd": 2 * 0.126 * 2, "storage_cost_usd": 3 * 0.023 / 30, "request_cost_usd": 0.01,
        "transfer_cost_usd": 0.09, "broker_cost_usd": 0.21 * 2 * 3, "database_cost_usd": 0.068 * 2,
    }
    for name, value in items.items():
        assert got[name] == round(value, 4)
    total = sum(round(v, 4) for v in items.values())
    assert got["total_cost_usd"] == pytest.approx(round(total, 4))
    assert got["cost_per_record_usd"] == pytest.approx(round(total / 2000, 8))
    small = runlog.run_cost(log, nodes=1, include_broker=False, include_database=False).first()
    assert "broker_cost_usd" not in small.asDict() and small["compute_cost_usd"] == 0.252


def test_counters(log):
    assert rows(runlog.counters(log)) == [
        ("errors", "load", "IOError", 1),
        ("records_processed", "extract", "csv", 107),
        ("records_processed", "load", "csv", 50),
        ("records_processed", "load", "json", 50),
    ]


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("s", v) for v in (0.1, 0.2, 1.0, 700.0, None)], "stage string, v double")
    got = {r["le"]: r["bucket_count"] for r in runlog.histogram(df, "stage", "v", fx.DURATION_BOUNDS).collect()}
    assert (got[0.1], got[0.5], got[1.0], got[600.0], got[None]) == (1, 2, 3, 3, 4)


def test_timer_rows(spark, tmp_path):
    timer = runlog.StageTimer("run")
    with timer.stage("good") as facts:
        facts["records"] = 3
    with pytest.raises(KeyError):
        with timer.stage("bad"):
            raise KeyError("x")
    path = timer.append(spark, str(tmp_path / "log"))
    assert rows(spark.read.parquet(path), "run_id", "stage", "records", "error_type") == [
        ("run", "bad", None, "KeyError"),
        ("run", "good", 3, None),
    ]


def test_rounding_of_binary_values(spark):
    from carelake.functions.records import nearest

    values = [0.13644999, 2.5, -2.5, 1e-9, 123456.78951, -0.00005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(nearest(F.col("v"), 4)).collect()]
    assert got == [0.1364, 2.5, -2.5, 0.0, 123456.7895, -0.0001]


# -- alert rules against brute force -----------------------------------------------------------------

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
seconds = st.lists(st.integers(0, 4000), min_size=1, max_size=40)


def timed(spark, offsets, label="s"):
    data = [(label, START + timedelta(seconds=o)) for o in offsets]
    # a second label holds a burst, so that one label dominates
    data += [("hot", START + timedelta(seconds=i % 50)) for i in range(200)]
    return spark.createDataFrame(data, "stage string, ts timestamp")


@settings(max_examples=5, deadline=None, suppress_health_check=NO_FIXTURE_CHECK)
@given(offsets=seconds)
def test_trailing_counts_match_brute_force(spark, offsets):
    got = alerts.trailing_counts(timed(spark, offsets), ["stage"], "ts", 300).where("stage = 's'")
    epoch = int(START.timestamp())
    want = {}
    for tick in range(epoch, epoch + 4500, 60):
        n = sum(tick - 300 <= epoch + o < tick for o in offsets)
        if n:
            want[tick] = n
    assert {r["tick"]: r["n"] for r in got.collect()} == want


@settings(max_examples=5, deadline=None, suppress_health_check=NO_FIXTURE_CHECK)
@given(offsets=seconds, hold=st.sampled_from([0, 60, 180]))
def test_error_rate_spans_match_brute_force(spark, offsets, hold):
    limit = 1.5 / 300
    got = alerts.error_rate(timed(spark, offsets), ["stage"], "ts", limit, hold_seconds=hold).where("stage = 's'")
    epoch, spans, run = int(START.timestamp()), [], []
    for tick in range(epoch, epoch + 4560, 60):
        if sum(tick - 300 <= epoch + o < tick for o in offsets) / 300 > limit:
            run.append(tick)
        elif run:
            spans.append(("s", run[0], run[-1], len(run)))
            run = []
    want = [s for s in spans if s[2] - s[1] >= hold]
    assert rows(got) == sorted(want)


@settings(max_examples=6, deadline=None, suppress_health_check=NO_FIXTURE_CHECK)
@given(offsets=st.lists(st.integers(0, 20_000), min_size=1, max_size=15))
def test_idle_spans_match_brute_force(spark, offsets):
    end = START + timedelta(seconds=24_000)
    got = alerts.idle_spans(timed(spark, offsets), ["stage"], "ts", until=F.lit(end)).where("stage = 's'")
    ordered = sorted(offsets) + [24_000]
    want = [float(b - a) for a, b in zip(ordered, ordered[1:]) if b - a > 1500]
    assert sorted(r["gap_seconds"] for r in got.collect()) == sorted(want)
    open_ended = alerts.idle_spans(timed(spark, offsets), ["stage"], "ts").where("stage = 's'")
    closed = [float(b - a) for a, b in zip(ordered[:-1], ordered[1:-1]) if b - a > 1500]
    assert sorted(r["gap_seconds"] for r in open_ended.collect()) == sorted(closed)


def test_limits(spark):
    profile = spark.createDataFrame([("a", 600.0), ("b", 600.1)], "stage string, duration_seconds double")
    assert rows(alerts.slow_stages(profile), "stage") == [("b",)]
    events = spark.createDataFrame([("q", at("2024-01-01 00:00:00")), ("p", at("2024-01-01 00:05:00"))], "q string, ts timestamp")
    lags = alerts.stream_lag(events, "q", "ts", "2024-01-01 00:10:00")
    assert rows(lags) == [("p", 300.0), ("q", 600.0)]
    assert rows(alerts.lagging_streams(lags), "query") == [("q",)]


def test_samples(log):
    got = runlog.samples(log, ["stage"], "started", F.max("duration"), "1 minute")
    assert ("load", at("2024-01-01 00:02:00"), 6.0) in rows(got)


def test_gauge_must_stay_above_its_limit(spark):
    minutes = {"a": [0.4, 0.4, 0.4, 0.2, 0.5], "b": [0.4, 0.1, 0.4, 0.1, 0.4], "c": [0.3] * 5}
    data = [(k, START + timedelta(minutes=i), v) for k, vs in minutes.items() for i, v in enumerate(vs)]
    samples = spark.createDataFrame(data, "layer string, at timestamp, value double")
    got = alerts.gauge_held(samples, ["layer"], 0.3, 60, 120)
    epoch = int(START.timestamp())
    assert rows(got) == [("a", epoch, epoch + 120, 3)]
    assert alerts.gauge_held(samples, ["layer"], 0.3, 60, 0).where("layer = 'b'").count() == 3


def test_lag_must_last(spark):
    events = spark.createDataFrame([("q", START + timedelta(seconds=s)) for s in (0, 600, 1201)], "q string, ts timestamp")
    got = alerts.lag_held(events, "q", "ts", until=F.lit(START + timedelta(seconds=1500)))
    assert rows(got, "gap_seconds") == [(601.0,)]


def test_spans_of_broken_steps_are_refused(spark):
    events = spark.createDataFrame([("e", at("2024-01-01 00:00:10"))], "kind string, ts timestamp")
    with pytest.raises(ValueError, match="multiple"):
        alerts.trailing_counts(events, ["kind"], "ts", 90, 60)
    assert alerts.trailing_counts(events, ["kind"], "ts", 90, 30).count() == 3
