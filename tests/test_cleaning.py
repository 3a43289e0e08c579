from pyspark.sql import Observation
from pyspark.sql import functions as F

from carelake.functions import records, vitals
from carelake.operators import cleaning
from carelake.session import observed
from helpers import at, rows


def test_clean_removes_copies_and_counts_them(people):
    seen = Observation(), Observation()
    cleaned = cleaning.clean(people, "2024-02-01 00:00:00", counted=seen)
    assert len(cleaned.collect()) == 4
    assert [observed(s, ["rows"])["rows"] for s in seen] == [5, 4]
    seen = Observation(), Observation()
    assert cleaning.clean(people.limit(0), counted=seen).collect() == []
    assert [observed(s, ["rows"])["rows"] for s in seen] == [0, 0]
    assert cleaned.first()["processing_time"] == at("2024-02-01 00:00:00")


def test_clean_drops_rows_without_id_or_time(spark):
    df = spark.createDataFrame(
        [("a", "t"), (None, "t"), ("b", None), ("c", "t"), ("c", "t")], "patient_id string, timestamp string"
    )
    assert rows(cleaning.clean(df), "patient_id") == [("a",), ("c",)]


def test_enrichment_classes(people):
    got = {
        r["patient_id"]: (r["sistolica"], r["diastolica"], r["categoria_pressao"], r["categoria_fc"], r["febre"])
        for r in cleaning.enrich(people).collect()
    }
    assert got == {
        "PAC-100001": (130, 85, "normal", "normal", False),
        "PAC-100002": (160, 100, "alta", "normal", False),
        "PAC-100003": (120, 80, "normal", "normal", True),
        "PAC-100004": (85, 55, "baixa", "bradicardia", False),
    }


def test_pressure_parsing_edges(spark):
    cases = {
        " 120 / 80 ": (120, 80),
        "120/80/70": (120, 80),
        "120": (120, None),
        "/80": (None, 80),
        "bad": (None, None),
        "120.9/x": (120, None),
        "12O/80": (None, 80),
        "1e2/80": (None, 80),
        "99999999999/80": (None, 80),
        "\t120\n/\r80": (120, 80),
        "": (None, None),
        None: (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = df.select(
        "p", vitals.pressure_reading(F.col("p"), 0).alias("s"), vitals.pressure_reading(F.col("p"), 1).alias("d")
    )
    assert {r["p"]: (r["s"], r["d"]) for r in got.collect()} == cases


def test_class_boundaries(spark):
    pressure = {
        (89, 80): "baixa", (90, 60): "normal", (90, 59): "baixa", (139, 89): "normal", (140, 80): "alta",
        (120, 90): "alta", (89, 120): "baixa", (None, None): "normal", (None, 95): "alta", (150, None): "alta",
    }
    df = spark.createDataFrame(list(pressure), "s int, d int")
    named = df.select("s", "d", vitals.pressure_class(F.col("s"), F.col("d")).alias("c"))
    assert {(r["s"], r["d"]): r["c"] for r in named.collect()} == pressure

    rates = {59: "bradicardia", 60: "normal", 100: "normal", 101: "taquicardia", None: "normal"}
    df = spark.createDataFrame([(k,) for k in rates], "r int")
    named = df.select("r", vitals.heart_rate_class(F.col("r")).alias("c"))
    assert {r["r"]: r["c"] for r in named.collect()} == rates

    fevers = {37.7: False, 37.8: True, 40.0: True, None: False}
    df = spark.createDataFrame([(k,) for k in fevers], "t double")
    assert {r["t"]: r["f"] for r in df.select("t", vitals.is_fever(F.col("t")).alias("f")).collect()} == fevers


def test_enrichment_needs_its_columns(people):
    without_pressure = people.drop("blood_pressure")
    assert cleaning.enrich(without_pressure).columns == without_pressure.columns
    partial = cleaning.enrich(people.select("blood_pressure", "temperatura")).columns
    assert "febre" in partial and "categoria_fc" not in partial


def test_stack_fills_missing_columns_and_aligns_times(spark):
    a = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "k int, timestamp string")
    b = spark.createDataFrame([("x", "not a time"), ("y", "2024-01-02T05:00:00")], "v string, timestamp string")
    c = a.select(F.lit(2).alias("k"), F.lit("2024-01-03").cast("timestamp").alias("timestamp"))
    got = cleaning.stack(*[cleaning.with_event_instant(df) for df in (a, b, c)])
    assert rows(got, "k", "v", "timestamp") == [
        (1, None, at("2024-01-01")),
        (2, None, at("2024-01-03")),
        (None, "x", None),
        (None, "y", at("2024-01-02 05:00:00")),
    ]


def test_record_metrics(spark):
    df = spark.createDataFrame([("á", None, "2024-01-01 00:00:00"), ("b", 2, None)], "a string, n int, timestamp string")
    got = cleaning.add_record_metrics(df, "2024-01-01 00:01:30").collect()
    body = '{"a":"á","timestamp":"2024-01-01 00:00:00","processing_lag_ms":90000}'
    assert (got[0]["processing_lag_ms"], got[0]["record_size_bytes"]) == (90000, len(body))
    assert (got[1]["processing_lag_ms"], got[1]["record_size_bytes"]) == (None, len('{"a":"b","n":2}'))
    octets = df.limit(1).select(records.json_bytes(F.col("a"))).first()[0]
    assert octets == len('{"a":"á"}'.encode())


def test_full_silver_transform(people):
    silver = cleaning.to_silver(people, key="k", as_of="2024-02-01 00:00:00")
    assert silver.count() == 4
    assert {"sistolica", "processing_time"} <= set(silver.columns)
    assert all(len(r["patient_id"]) == 64 for r in silver.collect())
    clear = cleaning.to_silver(people)
    assert all(r["patient_id"].startswith("PAC-") for r in clear.collect())


def test_check_digits(spark):
    cases = {"123.456.789-09": True, "529.982.247-25": True, "123.456.789-00": False, "12345678909": True, "1": False}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,), ("abc.def.ghi-jk",)], "cpf string")
    got = {r["cpf"]: r["ok"] for r in df.select("cpf", records.cpf_is_valid(F.col("cpf")).alias("ok")).collect()}
    assert {k: got[k] for k in cases} == cases
    assert got["abc.def.ghi-jk"] is False and not got[None]


def test_display_rounding_is_half_up(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (36.65,), (-0.25,)], "v double")
    shown = [float(r[0]) for r in df.select(records.display_round(F.col("v"))).collect()]
    assert shown == [0.3, 0.4, 36.7, -0.3]
    assert df.select(records.ratio_pct(F.lit(1), F.lit(0))).first()[0] is None
    assert float(df.select(records.ratio_pct(F.lit(1), F.lit(3))).first()[0]) == 33.33
