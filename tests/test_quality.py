from pyspark.sql import functions as F
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelake.operators import alerts, gold, quality
from helpers import at, rows


def test_report_of_the_sample(people):
    report = quality.quality_report(people, "RAW").first()
    assert (report["stage"], report["total_records"], report["columns"], report["duplicates"]) == ("RAW", 5, 16, 1)
    assert report["null_columns"] == {"medicamento": 1}
    assert report["null_pct"] == {"medicamento": 20.0}


def test_report_of_nothing(people):
    empty = people.limit(0)
    report = quality.quality_report(empty).first()
    assert (report["total_records"], report["duplicates"], report["null_columns"]) == (0, 0, {})
    assert rows(quality.threshold_alerts(empty)) == [("ERROR", None, None)]
    score = quality.scorecard(empty, "x").first()
    assert [score[c] for c in ("total_records", "completeness", "uniqueness", "consistency", "timeliness", "dqs_score")] == [0] * 6
    duplicate = quality.duplicate_report(empty).first()
    assert (duplicate["duplicates"], duplicate["duplicate_ratio"]) == (0, 0.0)
    assert quality.completeness(empty).first()[0] == 0.0 and quality.uniqueness(empty).first()[0] == 0.0


def test_threshold_is_exclusive(spark):
    df = spark.createDataFrame([(None, None)] * 3 + [(None, 1)] + [(1, 1)] * 6, "a int, b int")
    assert rows(quality.threshold_alerts(df)) == [("WARNING", "a", 40.0)]


def test_scores_by_hand(spark):
    df = spark.createDataFrame(
        [
            ("p1", 70, 36.5, "M", at("2024-01-01 12:00:00")),
            ("p1", 70, 36.5, "M", at("2024-01-01 12:00:00")),
            ("p2", 20, None, "X", None),
            (None, 220, 42.0, None, at("2024-01-01 06:00:00")),
        ],
        "patient_id string, heart_rate int, temperatura double, sexo string, timestamp timestamp",
    )
    score = quality.scorecard(df, "silver", ["patient_id"], max_age_hours=24, as_of="2024-01-01 18:00:00").first()
    complete = 1 - 4 / 20
    unique, consistent, timely = 3 / 4, (3 / 4 + 3 / 4 + 2 / 4) / 3, 1 - 6 / 24
    assert score["completeness"] == round(complete, 4)
    assert score["uniqueness"] == unique
    assert score["consistency"] == round(consistent, 4)
    assert score["timeliness"] == timely
    assert score["dqs_score"] == pytest.approx(0.3 * complete + 0.25 * unique + 0.25 * consistent + 0.2 * timely, abs=1e-4)
    assert quality.uniqueness(df).first()[0] == 0.75
    assert quality.consistency(df.select("patient_id")).first()[0] == 1.0


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("timestamp", at("2024-01-01 12:00:00"), 0.5),
        ("timestamp", at("2024-01-02 12:00:00"), 1.5),
        ("timestamp", at("2023-01-01 12:00:00"), 0.0),
        ("timestamp", None, 0.0),
        ("string", "2024-01-01 12:00:00", 0.5),
        ("string", "yesterday", 0.5),
        ("int", 7, 0.5),
        ("int", None, 0.0),
    ],
)
def test_timeliness_rules(spark, kind, value, expected):
    df = spark.createDataFrame([(value,)], f"timestamp {kind}")
    got = quality.timeliness(df, max_age_hours=24, as_of="2024-01-02 00:00:00").first()[0]
    assert got == pytest.approx(expected)
    assert quality.timeliness(df, "absent").first()[0] == 1.0


def test_profile_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "a", True, [1]), (1, None, "a", True, [2]), (1, 4.0, None, None, [1]), (1, -0.0, "", True, [1]), (1, 0.0, "b", True, None)],
        "one int, real double, text string, flag boolean, list array<int>",
    )
    got = {r["column"]: r for r in quality.column_profile(df).collect()}
    facts = {c: (r["null_count"], r["null_pct"], r["distinct_count"], r["distinct_pct"]) for c, r in got.items()}
    assert facts == {
        "one": (0, 0.0, 1, 20.0),
        "real": (1, 20.0, 4, 80.0),
        "text": (1, 20.0, 4, 80.0),
        "flag": (1, 20.0, 2, 40.0),
        "list": (1, 20.0, 3, 60.0),
    }
    assert (got["one"]["mean"], got["one"]["stddev"], got["text"]["mean"]) == (1.0, 0.0, None)
    assert got["real"]["mean"] == 1.5 and got["real"]["stddev"] == round(math.sqrt(11 / 3), 4)
    found = rows(quality.anomalies(quality.column_profile(df)), "type", "column", "severity")
    assert found == [("constant_column", "one", "info")]


def test_estimated_distinct_counts(spark):
    df = spark.range(20_000).selectExpr("id AS k", "id % 50 AS g", "IF(id % 2 = 0, NULL, 'x') AS v")
    exact = {r["column"]: r for r in quality.column_profile(df).collect()}
    guess = {r["column"]: r for r in quality.column_profile(df, relative_error=0.02).collect()}
    assert guess.keys() == exact.keys()
    for c in exact:
        assert guess[c]["distinct_count"] == pytest.approx(exact[c]["distinct_count"], rel=0.1)
        assert [guess[c][k] for k in ("null_count", "min", "max", "mean", "stddev")] == [
            exact[c][k] for k in ("null_count", "min", "max", "mean", "stddev")
        ]
    assert quality.uniqueness(df, ["g"], 0.02).first()[0] == pytest.approx(50 / 20_000, rel=0.1)


def test_suspicious_equals_the_anomalies_of_the_exact_profile(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 1, 'a', 0.0D, CAST(NULL AS STRING), array(1), true, 5.0D),
        (1, NULL, 'a', -0.0D, NULL, array(1), true, 5.0D), (1, NULL, 'b', 0.0D, NULL, array(1), NULL, NULL)
        AS t(one, few, text, zero, none, list, flag, same)""")
    for frame in (df, df.where("false"), df.select(*[F.col(c).alias(f"{c}{i}") for i in range(9) for c in df.columns])):
        got = rows(quality.suspicious(frame), "type", "column", "value", "threshold", "severity")
        assert got == rows(quality.anomalies(quality.column_profile(frame)), "type", "column", "value", "threshold", "severity")
        report = quality.quality_report(frame).first()
        nulls = {c: frame.where(F.col(c).isNull()).count() for c in frame.columns[:10]}
        assert {c: n for c, n in report["null_columns"].items() if c in nulls} == {c: n for c, n in nulls.items() if n}
        assert report["duplicates"] == frame.count() - frame.distinct().count()


def test_anomalies_of_a_profile(spark):
    profile = spark.createDataFrame(
        [("a", 4, 40.0, 2, None), ("b", 0, 0.0, 1, 0.0), ("c", 0, 0.0, 3, 0.0), ("d", 3, 30.0, 1, None)],
        "column string, null_count bigint, null_pct double, distinct_count bigint, stddev double",
    )
    assert rows(quality.anomalies(profile), "type", "column", "value") == [
        ("constant_column", "b", None),
        ("high_null_ratio", "a", 40.0),
        ("zero_variance", "c", None),
    ]


def test_gauges_and_their_alerts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "x")], "k int, v string")
    gauge = quality.gauges({"silver": df})
    assert rows(gauge, "metric", "column", "value") == [
        ("active_records", None, 4.0),
        ("duplicate_ratio", None, 0.25),
        ("null_ratio", "k", 0.0),
        ("null_ratio", "v", 0.5),
    ]
    assert rows(alerts.high_nulls(gauge), "column") == [("v",)]
    assert rows(alerts.high_duplicates(gauge)) == [("silver", 0.25)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c``d` string")
    assert quality.quality_report(df).first()["null_columns"] == {"c`d": 1}
    assert {r["column"] for r in quality.column_profile(df).collect()} == {"a.b", "c`d"}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a", "b"])), min_size=1, max_size=30))
def test_duplicates_match_brute_force(spark, data):
    """One value may hold most rows; the count of surplus copies stays exact."""
    df = spark.createDataFrame(data + [(1, "a")] * 40, "k int, v string")
    everything = Counter(data + [(1, "a")] * 40)
    got = quality.duplicate_report(df).first()
    assert got["duplicates"] == sum(everything.values()) - len(everything)
    assert got["distinct_records"] == len(everything)


def test_gold_by_hand(spark):
    silver = spark.createDataFrame(
        [("x", "PE", 80, 120, 80, 36.0, "normal"), ("x", "RJ", 90, 150, 95, 37.0, "alta"), (None, "RJ", 70, None, None, None, "normal")],
        "diagnostico string, estado string, heart_rate int, sistolica int, diastolica int, temperatura double, categoria_pressao string",
    )
    frame = gold.by_diagnosis(silver)
    assert set(rows(frame)) == {(None, 1, 70.0, None, None, None), ("x", 2, 85.0, 135.0, 87.5, 36.5)}
    assert rows(gold.by_state(silver)) == [("PE", 1, 80.0, 0), ("RJ", 2, 80.0, 1)]
    assert rows(gold.by_pressure(silver)) == [("alta", 1, 150.0, 95.0), ("normal", 2, 120.0, 80.0)]
    assert gold.by_state(silver.drop("estado")) is None
    assert gold.total_encounters(frame).first()[0] == 3 and gold.group_number(frame).first()[0] == 2
    assert [tuple(r) for r in gold.chart(frame).collect()] == [("x", 2)]
    assert [r["diagnostico"] for r in gold.ranked(frame, "total_pacientes", "diagnostico", top=1).collect()] == ["x"]


def test_timeline_sorts_by_calendar(spark):
    days = ["1/9/21", "12/31/20", "1/10/21"]
    df = spark.createDataFrame([(d, 1, 0) for d in days], "data string, casos_acumulados long, mortes_acumuladas long")
    assert [r["data"] for r in gold.timeline(df).collect()] == ["12/31/20", "1/9/21", "1/10/21"]


@pytest.mark.parametrize("make", [lambda: None, lambda: F.lit(7), lambda: F.pmod(F.hash("k"), F.lit(2))])
def test_copies_are_exact_when_hashes_collide(spark, make):
    row_hash = make()
    df = spark.createDataFrame([(i % 7 or None, str(i % 5) if i % 3 else None) for i in range(60)] + [(99, "x")], "k int, v string")
    want = (61, df.distinct().count())
    assert tuple(quality.row_counts(df, row_hash).first()) == want
    assert tuple(quality.row_counts(df.limit(0), row_hash).first()) == (0, 0)


def test_profile_reads_its_source_once(spark, tmp_path):
    spark.range(500).selectExpr("id", "CAST(id % 7 AS decimal(10,2)) AS d", "'x' AS s").write.parquet(str(tmp_path / "p"))
    profile = quality.column_profile(spark.read.parquet(str(tmp_path / "p")))
    got = {r["column"]: r for r in profile.collect()}
    assert got["d"]["mean"] == pytest.approx(2.988, abs=1e-3) and got["id"]["stddev"] == pytest.approx(144.4818, abs=1e-4)
    final = profile._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_report_alerts_equal_threshold_alerts(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, "y", "x")], "a int, b string, c string")
    for rows_in in (df, df.limit(0)):
        mine = quality.report_alerts(quality.quality_report(rows_in, "s")).drop("stage")
        assert rows(mine) == rows(quality.threshold_alerts(rows_in))


@pytest.mark.parametrize("slots", [1, 3, quality.SLOTS])
def test_copies_are_counted_without_a_shuffle_of_whole_rows(spark, monkeypatch, slots):
    """Whatever slots hashes share. Rows are chosen by a broadcast of marks, also where the rows are far
    too large to be broadcast themselves."""
    monkeypatch.setattr(quality, "SLOTS", slots)
    df = spark.range(300).selectExpr("IF(id % 7 = 0, NULL, id DIV 2) AS a", "repeat('x', CAST(id DIV 2 % 5 AS INT)) AS b")
    want = (300, len(set(map(tuple, df.collect()))))
    assert tuple(quality.row_counts(df).first()) == want
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quality.row_counts(df)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
