"""Types that grow, curves, compaction and merges on ranges."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators import history, intervals
from carelake.sources import curves, tables, widening
from carelake.sources.tables import VersionedTable
from helpers import rows

DAYS = [f"2024-01-{day:02d} 00:00:00" for day in (1, 2, 3, 4)]


# -- types that grow -------------------------------------------------------------------------------


def kind(text):
    return T._parse_datatype_string(text)


def test_lattice(spark):
    grows = {
        ("tinyint", "int"): "int", ("bigint", "int"): "bigint", ("int", "decimal(5,2)"): "decimal(12,2)", ("bigint", "decimal(38,2)"): "decimal(38,2)", ("bigint", "decimal(38,22)"): "double",
        ("decimal(10,2)", "decimal(6,4)"): "decimal(12,4)", ("float", "float"): "float", ("float", "int"): "double", ("decimal(5,1)", "float"): "double",
        ("date", "timestamp"): "timestamp", ("timestamp_ntz", "date"): "timestamp_ntz", ("array<int>", "array<bigint>"): "array<bigint>",
        ("map<string,int>", "map<string,double>"): "map<string,double>", ("struct<a:int>", "struct<a:bigint,b:string>"): "struct<a:bigint,b:string>",
    }
    for (a, b), c in grows.items():
        assert widening.wider(kind(a), kind(b)).simpleString() == c
        assert widening.wider(kind(b), kind(a)) is not None
    for a, b in [("string", "int"), ("date", "int"), ("timestamp", "timestamp_ntz"), ("boolean", "int"), ("array<int>", "int"), ("binary", "string")]:
        assert widening.wider(kind(a), kind(b)) is None
    with pytest.raises(TypeError, match="column a is int, which string does not fit"):
        widening.widened(kind("struct<a:int>"), kind("struct<a:string>"))


def test_appends_grow_types_and_old_versions_stay(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.save(spark.createDataFrame([(1, 1.5, date(2024, 1, 1))], "k int, v float, d date"), as_of=DAYS[0])
    t.save(spark.createDataFrame([(2**40, 2.25, datetime(2024, 1, 2, 3))], "k bigint, v double, d timestamp"), mode="append", as_of=DAYS[1])
    t.save(spark.createDataFrame([(7, "new")], "k tinyint, w string"), mode="append", as_of=DAYS[2])
    assert t.read(version=0).dtypes == [("k", "int"), ("v", "float"), ("d", "date")]
    assert t.read().dtypes == [("k", "bigint"), ("v", "double"), ("d", "timestamp"), ("w", "string")]
    assert set(rows(t.read(version=1), "k", "v")) == {(1, 1.5), (2**40, 2.25)}
    assert set(rows(t.read(), "k", "d", "w")) == {(1, datetime(2024, 1, 1), None), (2**40, datetime(2024, 1, 2, 3), None), (7, None, "new")}
    assert rows(t.read().where("k = 7"), "w") == [("new",)]
    # a snapshot starts anew, with types of its own
    t.save(spark.createDataFrame([("x",)], "k string"), as_of=DAYS[3])
    assert rows(t.read()) == [("x",)] and t.read(version=2).count() == 3


def test_types_that_do_not_fit_are_refused_before_anything_is_written(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.save(spark.createDataFrame([(1, True)], "k int, b boolean"))
    for bad in (("x", True), (2, 5)):
        frame = spark.createDataFrame([bad])
        frame = frame.toDF("k", "b")
        with pytest.raises(TypeError, match="does not fit"):
            t.save(frame, mode="append")
    assert rows(t.read()) == [(1, True)]
    assert [p.name for p in (tmp_path / "t" / "data").iterdir() if p.name.startswith("version")] == ["version=0"]
    assert t.merge(spark.createDataFrame([(1, False), (9, True)], "k int, b boolean"), keys=["k"]) == {"inserted": 1, "updated": 1, "deleted": 0}


# -- the curve -------------------------------------------------------------------------------------


def test_interleaving_equals_brute_force(spark):
    rng = random.Random(1)
    for columns, bits in ((1, 10), (2, 10), (3, 7), (9, 10)):
        data = [tuple(rng.randrange(1 << bits) for _ in range(columns)) for _ in range(50)]
        frame = spark.createDataFrame(data, ", ".join(f"c{i} int" for i in range(columns)))
        words = curves.interleaved([F.col(f"c{i}") for i in range(columns)], bits)
        got = [tuple(r) for r in frame.select(*words).collect()]
        for ranks, found in zip(data, got):
            text = "".join(str(r >> b & 1) for b in reversed(range(bits)) for r in ranks)
            assert found == tuple(int(text[i : i + curves.WORD_BITS], 2) for i in range(0, len(text), curves.WORD_BITS))


def test_ranks_of_any_type(spark):
    frame = spark.range(4096).select(
        F.when(F.col("id") % 7 > 0, F.format_string("PAC-%06d", F.col("id"))).alias("s"),
        F.timestamp_seconds(F.col("id") * F.col("id")).alias("t"),
        F.col("id").cast("decimal(20,3)").alias("d"),
        F.least(F.col("id"), F.lit(3)).alias("few"),
        F.lit(None).cast("int").alias("none"),
    )
    bounds = curves.sampled_bounds(frame, frame.columns, 4)
    ranks = [F.lit(0) if b is None else curves.rank(F.col(c), b, 4) for c, b in zip(frame.columns, bounds)]
    for c, r in zip(frame.columns, ranks):
        pairs = frame.select(F.col(c).alias("v"), r.alias("r")).where("v IS NOT NULL").distinct().orderBy("v").collect()
        placed = [p["r"] for p in pairs]
        assert placed == sorted(placed)
    spread = frame.groupBy(curves.rank(F.col("t"), bounds[1], 4)).count().collect()
    assert len(spread) == 16 and max(r["count"] for r in spread) < 300
    assert rows(frame.where("s IS NULL").select(ranks[0].alias("r")).distinct()) == [(0,)]


def test_filters_on_either_column_skip_most_files(spark, tmp_path):
    frame = spark.range(40_000).select((F.col("id") * 7919 % 10_007).alias("a"), F.format_string("name-%05d", F.col("id") * 104_729 % 9_973).alias("b"))
    t = VersionedTable(spark, str(tmp_path / "z"))
    t.save(frame)
    t.cluster(["a", "b"], files=64)
    t.zorder(["a", "b"], files=64)

    def met(version, condition):
        files = t.read(version=version).groupBy(F.input_file_name()).agg(F.count_if(F.expr(condition)).alias("n"))
        return files.where("n > 0").count()

    on_b = "b BETWEEN 'name-01000' AND 'name-01400'"
    assert met(2, "a BETWEEN 1000 AND 1400") <= 20
    assert met(2, on_b) <= 20 and met(2, on_b) * 2 < met(1, on_b)
    assert rows(t.read().agg(F.count("*"), F.sum("a"), F.sum(F.hash("b")))) == rows(frame.agg(F.count("*"), F.sum("a"), F.sum(F.hash("b"))))
    assert t.history(1).first()["operation"] == "OPTIMIZE ZORDER"
    empty = spark.createDataFrame([], "a int, b string")
    assert curves.zordered(empty, ["a", "b"], 4).count() == 0


# -- compaction ------------------------------------------------------------------------------------


def test_only_small_files_are_written_again(spark, tmp_path):
    path = str(tmp_path / "p")
    frame = spark.range(3000).select("id", (F.col("id") % 3).alias("p"), F.when(F.col("id") % 2 == 0, "x").alias("q"))
    frame.where("p = 0").coalesce(1).write.partitionBy("p", "q").parquet(path)
    frame.where("p > 0").repartition(5).write.mode("append").partitionBy("p", "q").parquet(path)

    def files(part):
        return sorted(str(f) for f in (tmp_path / "p").glob(f"p={part}/**/*.parquet"))

    before = files(0)
    done = tables.compact_partitions(spark, path, ["p", "q"])
    assert rows(done, "p", "q", "files") == [(1, "x", 5), (1, None, 5), (2, "x", 5), (2, None, 5)]
    assert files(0) == before and len(files(1)) == len(files(2)) == 2
    assert rows(spark.read.parquet(path), "id", "p", "q") == rows(frame)
    settled = files(1)
    assert tables.compact_partitions(spark, path, ["p", "q"]).isEmpty() and files(1) == settled
    assert tables.compact_partitions(spark, path, ["p", "q"], target_bytes=10).isEmpty()


# -- merges on ranges ------------------------------------------------------------------------------


def test_range_terms():
    good = {
        "source.at BETWEEN target.a AND target.b": ("source", "at", "a", "b"),
        "target.x > 1 AND target.`v` between source.lo and source.hi AND source.k > 2": ("target", "v", "lo", "hi"),
        "(target.x = 1 OR source.y = 2) AND source.at BETWEEN target.a AND target.b": ("source", "at", "a", "b"),
    }
    bad = [
        "source.at BETWEEN source.a AND target.b", "NOT source.at BETWEEN target.a AND target.b", "source.at BETWEEN target.a AND target.b OR target.x = 1",
        "source.at NOT BETWEEN target.a AND target.b", "source.at + 1 BETWEEN target.a AND target.b", "(source.at BETWEEN target.a AND target.b)",
        "source.at BETWEEN target.a AND target.b + 1", "1 + source.at BETWEEN target.a AND target.b", "f(source.at BETWEEN target.a AND target.b)",
    ]
    assert {c: history.range_term(c) for c in good} == good
    assert [c for c in bad if history.range_term(c)] == []


@pytest.mark.parametrize("cast", ["double", "bigint", "timestamp", "date", "decimal(20,2)"])
def test_intervals_of_all_widths_meet_their_values(spark, cast):
    rng = random.Random(cast)
    whole = cast not in ("double", "decimal(20,2)")
    spans = []
    for i in range(150):
        low = rng.uniform(-1e4, 1e4)
        spans.append((i, low, low + rng.choice([0, 1e-3, 1, 30, 5e3, 1e6, -1]) * rng.random()))
    spans += [(200, None, 1.0), (201, 5.0, 5.0), (202, -1e9, 1e9), (203, 2.0, None)]
    points = [(i, rng.uniform(-2e4, 2e4)) for i in range(300)] + [(900, 5.0), (901, None)] + [(1000 + i, s[1]) for i, s in enumerate(spans)]
    to = f"cast(cast(floor({{0}}) as bigint) as {cast})" if whole and cast != "date" else f"date_add(date'2020-01-01', cast({{0}} as int))" if cast == "date" else f"cast({{0}} as {cast})"
    if cast == "date":
        spans = [s for s in spans if s[0] != 202]
    held = spark.createDataFrame(spans, "i int, a double, b double").selectExpr("i", f"{to.format('a')} AS a", f"{to.format('b')} AS b")
    values = spark.createDataFrame(points, "p int, x double").selectExpr("p", f"{to.format('x')} AS x")
    binned = intervals.binned_intervals(held, F.col("a"), F.col("b"))
    assert binned.groupBy("i").count().agg(F.max("count")).first()[0] <= 3
    met = binned.join(intervals.binned_values(values, F.col("x"), intervals.levels(binned)), [intervals.LEVEL, intervals.BIN]).where("x BETWEEN a AND b")
    every = held.crossJoin(values).where("x BETWEEN a AND b")
    assert rows(met, "i", "p") == rows(every, "i", "p")


def test_extreme_numbers(spark):
    inf, nan = float("inf"), float("nan")
    spans = [(1, -inf, inf), (2, 0.0, 5e-324), (3, 1e308, inf), (4, nan, nan), (5, -1e-300, 1e-300), (6, 9.007199254740993e15, 9.007199254740995e15)]
    points = [(i, x) for i, x in enumerate([0.0, -0.0, 5e-324, 1e-301, 1e308, inf, -inf, nan, 9.007199254740994e15, 1.0])]
    held, values = spark.createDataFrame(spans, "i int, a double, b double"), spark.createDataFrame(points, "p int, x double")
    binned = intervals.binned_intervals(held, F.col("a"), F.col("b"))
    met = binned.join(intervals.binned_values(values, F.col("x"), intervals.levels(binned)), [intervals.LEVEL, intervals.BIN]).where("x BETWEEN a AND b")
    assert rows(met, "i", "p") == rows(held.crossJoin(values).where("x BETWEEN a AND b"), "i", "p")


def test_upsert_on_a_range(spark):
    target = spark.createDataFrame([("a", 0, 9, None, 1), ("b", 10, 19, None, 1), ("c", None, 5, None, 1), ("d", 100, 10_000, None, 1)], "k string, lo int, hi int, at int, v int")
    source = spark.createDataFrame([(5, 50), (25, 60), (5_000, 70), (None, 80)], "at int, v int")
    condition = "source.at BETWEEN target.lo AND target.hi AND source.v < 65"
    merged = history.upsert_where(target, source, condition, ["k"], action_column="did")
    want = {
        ("a", 0, 9, 5, 50, "updated"), ("b", 10, 19, None, 1, "kept"), ("c", None, 5, None, 1, "kept"), ("d", 100, 10_000, None, 1, "kept"),
        (None, None, None, 25, 60, "inserted"), (None, None, None, 5_000, 70, "inserted"), (None, None, None, None, 80, "inserted"),
    }
    assert set(rows(merged)) == want
    text = merged._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    twice = spark.createDataFrame([(5, 50), (6, 60)], "at int, v int")
    with pytest.raises(Exception, match="several source rows"):
        history.upsert_where(target, twice, "source.at BETWEEN target.lo AND target.hi", ["k"]).collect()


def test_points_of_any_size_share_a_level_and_no_copies_are_broadcast(spark):
    """Ranges of one value at 40 magnitudes: a value stands in one bin for all of them, and a table that
    is small before its rows are copied to bins is not sent to every task after."""
    target = spark.range(40).selectExpr("id AS k", "shiftleft(1L, CAST(id AS INT)) AS lo", "CAST(NULL AS BIGINT) AS at").withColumn("hi", F.col("lo"))
    source = spark.range(40).selectExpr("shiftleft(1L, CAST(id AS INT)) + id % 2 AS at")
    held = intervals.binned_intervals(target, F.col("lo"), F.col("hi"))
    assert len(intervals.levels(held)) == 1
    assert intervals.binned_values(source, F.col("at"), intervals.levels(held)).count() == 40
    merged = history.upsert_where(target, source, "source.at BETWEEN target.lo AND target.hi", ["k"], action_column="did")
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and intervals.BIN in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    # the odd ones miss their range by one
    assert {r["did"]: r["count"] for r in merged.groupBy("did").count().collect()} == {"updated": 20, "kept": 20, "inserted": 20}
