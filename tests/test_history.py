import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carelake.operators import history, privacy
from helpers import at, rows

FIELDS = "k int, name string, v int"
T0, T1, T2 = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")


def frame(spark, data, schema=FIELDS):
    return spark.createDataFrame(data, schema)


def test_upsert_updates_inserts_keeps(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 2), (None, "n", 0)])
    source = frame(spark, [(2, "B", None), (3, "c", 3), (None, "m", 9)])
    got = history.upsert(target, source, ["k"], action_column="act")
    assert set(rows(got)) == {
        (1, "a", 1, "kept"),
        (2, "B", None, "updated"),
        (3, "c", 3, "inserted"),
        (None, "n", 0, "kept"),
        (None, "m", 9, "inserted"),
    }


def test_upsert_of_some_columns(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "A", 10), (2, "B", 20)])
    got = history.upsert(target, source, ["k"], update_columns=["v"])
    assert set(rows(got)) == {(1, "a", 10), (2, "B", 20)}


def test_upsert_with_fewer_source_columns(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, 10), (2, 20)], "k int, v int")
    assert set(rows(history.upsert(target, source, ["k"]))) == {(1, "a", 10), (2, None, 20)}


def test_upsert_creates(spark):
    source = frame(spark, [(1, "a", 1)])
    assert rows(history.upsert(None, source, ["k"], action_column="act")) == [(1, "a", 1, "inserted")]


def test_upsert_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        history.upsert(frame(spark, [(1, "a", 1)]), frame(spark, [(1, 1)], "k int, other int"), ["k"])


def test_two_source_rows_for_one_target_row_fail(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "x", 1), (1, "y", 2)])
    with pytest.raises(PySparkException, match="several source rows"):
        history.upsert(target, source, ["k"]).collect()
    with pytest.raises(PySparkException, match="several source rows"):
        history.upsert(target, source, ["k"]).count()


def test_repeated_source_keys_without_a_match_are_all_inserted(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(5, "x", 1), (5, "y", 2)])
    assert set(rows(history.upsert(target, source, ["k"]))) == {(1, "a", 1), (5, "x", 1), (5, "y", 2)}


def test_one_source_row_updates_a_hot_key_everywhere(spark):
    """A third of the target shares one key; it is not the source side, so nothing multiplies."""
    target = frame(spark, [(0, "hot", i) for i in range(300)] + [(i, "cold", i) for i in range(1, 601)])
    source = frame(spark, [(0, "new", -1), (10_000, "fresh", 1)])
    got = history.upsert(target, source, ["k"], update_columns=["name"])
    counts = dict(rows(got.groupBy("name").count()))
    assert counts == {"new": 300, "cold": 600, "fresh": 1}


def test_condition_upsert(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 5), (2, "c", 2), (None, "n", 0)])
    source = frame(spark, [(1, "new", 3), (2, "low", 0), (None, "m", 9)])
    got = history.upsert_where(
        target, source, "target.k = source.k AND source.v > target.v", row_id=["k", "name"], action_column="act"
    )
    assert set(rows(got)) == {
        (1, "new", 3, "updated"),
        (1, "b", 5, "kept"),
        (2, "c", 2, "kept"),
        (None, "n", 0, "kept"),
        (2, "low", 0, "inserted"),
        (None, "m", 9, "inserted"),
    }
    twice = source.unionByName(frame(spark, [(1, "again", 4)]))
    with pytest.raises(PySparkException, match="several source rows"):
        history.upsert_where(target, twice, "target.k = source.k AND source.v > target.v", row_id=["k", "name"]).collect()


keys = st.one_of(st.none(), st.integers(0, 6))
records = st.lists(st.tuples(keys, st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=12)


def unique(data):
    seen = {}
    for row in data:
        seen.setdefault(row[0] if row[0] is not None else object(), row)
    return list(seen.values())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=records, source=records)
def test_upsert_matches_brute_force_and_is_idempotent(spark, target, source):
    source = [r for r in unique(source) if r[0] is not None]
    by_key = {r[0]: r for r in source}
    want = [by_key.get(r[0], r) if r[0] is not None else r for r in target]
    want += [r for r in source if r[0] not in {t[0] for t in target}]
    t, s = frame(spark, target), frame(spark, source)
    once = history.upsert(t, s, ["k"])
    assert rows(once) == sorted(want, key=repr)
    assert rows(history.upsert(once, s, ["k"])) == sorted(want, key=repr)


# -- slowly changing history -----------------------------------------------------------------------


def test_history_load(spark):
    first = history.scd2_start(frame(spark, [(1, "a", 1), (2, "b", 2), (3, "c", None)]), T0)
    load = frame(spark, [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 4), (None, "n", 0)])
    got = history.scd2_apply(first, load, ["k"], T1, action_column="act")
    t0, t1 = at(T0), at(T1)
    assert set(rows(got)) == {
        (1, "a", 1, t0, None, True, "kept"),
        (2, "b", 2, t0, t1, False, "closed"),
        (2, "B", 2, t1, None, True, "inserted"),
        (3, "c", None, t0, t1, False, "closed"),
        (3, "c", 3, t1, None, True, "inserted"),
        (4, "d", 4, t1, None, True, "inserted"),
        (None, "n", 0, t1, None, True, "inserted"),
    }


def test_history_as_of(spark):
    h = history.scd2_start(frame(spark, [(1, "a", 1)]), T0)
    h = history.scd2_apply(h, frame(spark, [(1, "b", 1)]), ["k"], T1)
    h = history.scd2_apply(h, frame(spark, [(1, "b", 1), (2, "x", 0)]), ["k"], T2)

    def names(t):
        return rows(history.scd2_as_of(h, t), "name")

    assert names("2023-12-31 23:59:59") == []
    assert names(T0) == names("2024-01-31 23:59:59") == [("a",)]
    assert names(T1) == [("b",)]
    assert names(T2) == [("b",), ("x",)] == rows(history.scd2_current(h), "name")


def test_history_load_rejects_two_rows_for_a_key(spark):
    h = history.scd2_start(frame(spark, [(1, "a", 1)]), T0)
    for key in (1, 7):
        with pytest.raises(PySparkException, match="several source rows"):
            history.scd2_apply(h, frame(spark, [(key, "x", 1), (key, "y", 2)]), ["k"], T1).collect()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(records, min_size=2, max_size=3))
def test_history_keeps_one_current_row_per_key(spark, loads):
    loads = [[r for r in unique(load) if r[0] is not None] for load in loads]
    h, state = None, {}
    for month, load in enumerate(loads, start=1):
        h = history.scd2_apply(h, frame(spark, load), ["k"], f"2024-{month:02d}-01 00:00:00")
        state.update({r[0]: r for r in load})
    current = history.scd2_current(h).select("k", "name", "v")
    assert rows(current) == sorted(state.values(), key=repr)
    again = history.scd2_apply(h, current, ["k"], "2025-01-01 00:00:00")
    assert rows(again) == rows(h)


# -- rights of the data subject --------------------------------------------------------------------


def test_erasure(spark):
    data = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "patient_id string, v int")
    asked = spark.createDataFrame(
        [("a", at("2024-01-01")), ("a", at("2024-01-01")), (None, at("2024-01-01")), ("b", at("2024-01-09"))],
        "patient_id string, requested_at timestamp",
    )
    flagged = privacy.soft_delete(data, asked.limit(3))
    assert set(rows(flagged)) == {("a", 1, True), ("a", 2, True), ("b", 3, False), (None, 4, False)}
    assert set(rows(privacy.visible(flagged))) == {("b", 3), (None, 4)}
    late = privacy.purge(data, asked, requested="requested_at", retention_hours=168, as_of="2024-01-10 00:00:00")
    assert set(rows(late, "v")) == {(3,), (4,)}
    assert set(rows(privacy.without_revoked(data, asked), "v")) == {(4,)}


def test_subject_access_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver = spark.createDataFrame([("a", 1), ("b", 2)], "patient_id string, v int")
    silver.select(F.sha2(F.concat("patient_id", F.lit("key")), 256).alias("patient_id"), "v").write.parquet(path)
    found = privacy.subject_rows(spark.read.parquet(path), "a", "key")
    assert rows(found, "v") == [(1,)]
    assert "PushedFilters: [IsNotNull(patient_id), EqualTo(patient_id," in found._jdf.queryExecution().toString()
    out = privacy.export_subject(found, str(tmp_path / "out"), "csv", ["v"])
    assert rows(spark.read.csv(out, header=True)) == [("1",)]
    with pytest.raises(ValueError):
        privacy.export_subject(found, out, "xml")
