import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from carelake.sources import tables, writers
from carelake.sources.tables import VersionedTable
from carelake.sources.writers import LakeLayout
from helpers import at, rows

D = [f"2024-01-{day:02d} 00:00:00" for day in (1, 2, 9, 10, 11)]


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), user="me")
    t.save(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), as_of=D[0])
    t.save(spark.createDataFrame([(3, "c", 1.5)], "k int, v string, extra double"), mode="append", as_of=D[1])
    t.merge(spark.createDataFrame([(1, "A"), (9, "z")], "k int, v string"), keys=["k"], as_of=D[2])
    return t


def test_time_travel(table):
    assert rows(table.read(version=0)) == [(1, "a"), (2, "b")]
    assert set(rows(table.read(version=1))) == {(1, "a", None), (2, "b", None), (3, "c", 1.5)}
    newest = {(1, "A", None), (2, "b", None), (3, "c", 1.5), (9, "z", None)}
    assert set(rows(table.read())) == set(rows(table.read(version=2))) == newest
    assert rows(table.read(at="2024-01-01 12:00:00")) == [(1, "a"), (2, "b")]
    assert table.read(at=D[1]).count() == 3
    for missing in ({"version": 7}, {"at": "2023-01-01 00:00:00"}):
        with pytest.raises(LookupError):
            table.read(**missing)


def test_history_newest_first(table):
    log = [tuple(r) for r in table.history().select("version", "operation", "user_name", "timestamp").collect()]
    assert log == [(2, "MERGE", "me", at(D[2])), (1, "WRITE", "me", at(D[1])), (0, "WRITE", "me", at(D[0]))]
    assert [r["version"] for r in table.history(limit=1).collect()] == [2]
    metrics = table.history(1).first()["metrics"]
    assert metrics == {"numOutputRows": 4, "inserted": 1, "updated": 1, "deleted": 0}


def test_merge_returns_counts(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "m"))
    rows_in = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert t.merge(rows_in, keys=["k"]) == {"inserted": 2, "updated": 0, "deleted": 0}
    assert t.merge(rows_in, keys=["k"]) == {"inserted": 0, "updated": 2, "deleted": 0}
    condition = "target.k = source.k AND source.v > target.v"
    newer = spark.createDataFrame([(1, "b"), (2, "a")], "k int, v string")
    assert t.merge(newer, condition=condition, row_id=["k"]) == {"inserted": 1, "updated": 1, "deleted": 0}
    with pytest.raises(ValueError):
        t.merge(newer)


def test_merge_settles_a_source_that_changes(spark, tmp_path):
    """Every read of this source would give other values; the merge sees one of them only."""
    t = VersionedTable(spark, str(tmp_path / "n"))
    t.save(spark.range(50).selectExpr("id AS k", "'old' AS v"))
    source = spark.range(100).selectExpr("CAST(rand() * 1000000 AS BIGINT) + id * 1000000 AS k", "uuid() AS v")
    counts = t.merge(source, keys=["k"])
    assert counts["inserted"] + counts["updated"] == 100
    assert t.read().count() == 50 + counts["inserted"]


def test_history_merge(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "h"))
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert t.merge_history(one, ["k"], D[0]) == {"inserted": 1, "closed": 0}
    assert t.merge_history(two, ["k"], D[1]) == {"inserted": 2, "closed": 1}
    assert t.merge_history(two, ["k"], D[2]) == {"inserted": 0, "closed": 0}
    assert t.read().count() == 3


def test_uncommitted_output_is_not_read_and_not_replaced(spark, table):
    spark.range(5).write.parquet(f"{table.root}/data/version=3")
    assert table.read().count() == 4
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        table.compact()
    assert table.read().count() == 4


def test_own_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="version"):
        VersionedTable(spark, str(tmp_path / "v")).save(spark.range(2).withColumnRenamed("id", "version"))


def test_a_named_commit_is_made_once(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "w"))
    assert t.commit(spark.range(3), "X", token="a") == t.commit(spark.range(3), "X", token="a") == 0
    assert t.commit(spark.range(5), "X", token="b") == 1
    assert t.commits().count() == 2 and t.read(0).count() == 3 and t.read().count() == 5


def test_partitioned_versions_keep_column_order(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "p"), partition_by=["part"])
    t.save(spark.createDataFrame([("x", 1), ("y", 2)], "part string, v int"))
    assert t.read().columns == ["part", "v"]
    assert rows(t.read()) == [("x", 1), ("y", 2)]


def test_retention(spark, table, tmp_path):
    table.compact(as_of=D[3])
    now = "2024-01-16 12:00:00"
    # version 2 was current until the 10th, so it is needed to read the table as of the 9th, 12:00
    assert rows(table.expired(168, now), "version") == [(0,), (1,)]
    before = set(rows(table.read()))
    files = lambda v: [p for p in (tmp_path / "t" / "data" / f"version={v}").rglob("*.parquet")]
    kept = {v: files(v) for v in (2, 3)}
    assert table.retain(168, now) == table.retain(168, now) == 2
    assert set(rows(table.read())) == before and table.read(version=2).count() == 4
    assert {v: files(v) for v in (2, 3)} == kept
    assert all(spark.read.schema("k int").parquet(f"{table.root}/data/version={v}").count() == 0 for v in (0, 1))
    for gone in (0, 1):
        with pytest.raises(LookupError):
            table.read(version=gone)


def test_retention_keeps_the_base_of_a_young_append(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "r"))
    one = spark.createDataFrame([(1,)], "k int")
    t.save(one, as_of="2024-01-01 00:00:00")
    t.save(one, as_of="2024-01-02 00:00:00")
    t.save(one, mode="append", as_of="2024-01-20 00:00:00")
    assert rows(t.expired(168, "2024-01-21 00:00:00"), "version") == [(0,)]
    assert rows(t.expired(168, "2025-01-01 00:00:00"), "version") == [(0,)]


def test_compaction_merges_files(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "c"))
    t.save(spark.range(1000).repartition(16))
    files = lambda: t.read().select(F.input_file_name()).distinct().count()
    before = files()
    t.compact()
    assert (before, files(), t.read().count()) == (16, 1, 1000)


def test_clustering_narrows_files(spark, tmp_path):
    """Ten columns, text of equal beginnings first: ranges of files follow each other."""
    df = spark.range(20_000).select(
        F.format_string("PAC-%09d", F.col("id") * 7919 % 10_007).alias("s"), *[(F.col("id") * (104729 + i) % 997).alias(f"c{i}") for i in range(9)]
    )
    t = VersionedTable(spark, str(tmp_path / "z"))
    t.save(df.repartition(8))
    t.cluster(df.columns, files=16)
    stored = t.read()
    sums = [F.count("*"), F.sum("c0"), F.sum("c8"), F.sum(F.hash("s"))]
    assert rows(stored.groupBy().agg(*sums)) == rows(df.groupBy().agg(*sums))
    spans = rows(stored.groupBy(F.input_file_name().alias("f")).agg(F.min("s").alias("a"), F.max("s").alias("b")), "a", "b")
    assert len(spans) == 16 and all(one[1] <= two[0] for one, two in zip(spans, spans[1:]))


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = tmp_path / "u"
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x"), (None, 1, "x")], "p string, k int, v string").write.partitionBy("p").parquet(str(path))
    untouched = sorted((path / "p=b").iterdir())
    source = spark.createDataFrame([("a", 2, "y"), ("c", 5, "z")], "p string, k int, v string")
    tables.upsert_partitions(spark, str(path), source, ["p", "k"], ["p"])
    stored = spark.read.schema("k int, v string, p string").parquet(str(path))
    assert set(rows(stored, "p", "k", "v")) == {("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), (None, 1, "x"), ("c", 5, "z")}
    assert sorted((path / "p=b").iterdir()) == untouched
    with pytest.raises(ValueError):
        tables.upsert_partitions(spark, str(path), source, ["k"], ["p"])


def test_clustering_splits_a_dominant_value(spark):
    df = spark.range(9_000).select(F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).cast("int").alias("k"), "id")
    laid = tables.clustered(df, ["k"], files=9)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2000


def test_clustering_takes_text_dates_and_nulls(spark):
    df = spark.createDataFrame([("b", None), (None, None), ("a", at(D[0])), ("c", at(D[1]))], "s string, t timestamp")
    assert set(rows(tables.clustered(df, ["s", "t"], files=2))) == set(rows(df))


# -- layers ----------------------------------------------------------------------------------------


def test_layers_roundtrip(spark, people, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    written = writers.write_layer(people, layout, "bronze", "people")
    assert written == writers.Written(f"{layout.root}/bronze/people", 5)
    assert rows(writers.read_layer(spark, layout, "bronze", "people")) == rows(people)
    again = writers.write_layer(people.limit(2), layout, "bronze", "people", mode="append")
    assert again.rows == 2 and writers.read_layer(spark, layout, "bronze", "people").count() == 7
    with pytest.raises(ValueError):
        layout.path("platinum")


def test_empty_frames_are_written_and_counted(spark, people, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    nothing = people.where("idade > 1000")
    for table, frame, by in (("a", nothing, ()), ("b", nothing.groupBy("sexo").count(), ["sexo"]), ("c", people.limit(0), ())):
        assert writers.write_layer(frame, layout, "gold", table, by).rows == 0


def test_dated_landing_prunes(spark, people, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    written = writers.land_by_date(people, layout, "silver", "people")
    assert written.rows == 5
    day = writers.read_layer(spark, layout, "silver", "people").where("date = DATE '2024-01-15'")
    assert day.count() == 5
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().toString()
    assert len(day.inputFiles()) == 1


def test_layer_bytes(spark, people, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    writers.write_layer(people, layout, "gold", "a")
    writers.write_layer(people, layout, "gold", "nested/b")
    got = writers.layer_bytes(spark, {"gold": layout.path("gold")}).first()
    files = [p for p in (tmp_path / "lake" / "gold").rglob("*.parquet")]
    assert got["files"] == len(files)
    assert got["size_bytes"] == sum(p.stat().st_size for p in files)


def test_columns_made_on_landing_are_not_shuffled(spark, people, tmp_path):
    """Rows are brought to their days before `refine` widens them; what is stored is the same."""
    seen = []

    def refine(rows):
        seen.append(rows)
        return rows.withColumn("long_name", F.repeat("nome", 50))

    here, there = LakeLayout(str(tmp_path / "a")), LakeLayout(str(tmp_path / "b"))
    written = writers.land_by_date(people, here, "silver", "people", refine=refine)
    writers.land_by_date(people.withColumn("long_name", F.repeat("nome", 50)), there, "silver", "people")
    assert written.rows == people.count()
    assert "Rebalance" in seen[0]._jdf.queryExecution().analyzed().toString() and seen[0].columns == people.columns
    stored = [writers.read_layer(spark, at, "silver", "people") for at in (here, there)]
    assert stored[0].columns == stored[1].columns
    assert sorted(map(str, stored[0].collect())) == sorted(map(str, stored[1].collect()))
