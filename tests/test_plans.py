"""What the physical plans of the registered queries must not contain, and what some must."""

import re

import pyarrow as pa
import pytest

from carelake.plans import catalog, inputs
from carelake.operators import cleaning, gold, history, quality
from helpers import SMALL

# queries that run streams or write tables first; their result is a plain scan
STAGED = {
    name
    for name in catalog.QUERIES
    if name.startswith(("medallion", "version", "commit_history", "roundtrip", "subject_export", "sliding_window", "envelope"))
} | {
    "layer_bytes", "retain_versions", "expired_versions", "compact", "late_rows", "stream_to_lake", "batch_and_stream",
    "paired_landing", "dated_landing", "upsert_partitions", "compact_files", "cluster_ranges", "schema_evolution", "csv_inferred_types", "feeds_landed",
}
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STAGED))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert not FORBIDDEN.search(text), FORBIDDEN.search(text).group()


def test_every_query_is_checked_or_known():
    unchecked = set(catalog.QUERIES) - set(catalog.CHECKS)
    assert unchecked == {"layer_bytes"}
    assert not any(re.match(r"op\d+_|pipeline", name) for name in catalog.QUERIES)


def test_projections_read_only_their_columns(spark):
    orders = plan(inputs.encounters(spark, SMALL).select("encounter_id", "estado"))
    assert "o_totalprice" not in orders and "c_name" not in orders and "o_orderpriority" not in orders


def test_gold_prunes_stored_silver(spark, tmp_path, people):
    cleaning.to_silver(people, "k").write.parquet(str(tmp_path / "s"))
    text = plan(gold.by_state(spark.read.parquet(str(tmp_path / "s"))))
    assert "ReadSchema: struct<estado:string,heart_rate:int,categoria_pressao:string>" in text


def test_one_scan_for_all_scores(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    for df in (
        quality.scorecard(stored, keys=["patient_id"], timestamp_column="timestamp"),
        quality.threshold_alerts(stored),
    ):
        assert plan(df).count("FileScan") == 1


def test_counting_copies_shuffles_hashes_only(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "h"))
    text = plan(quality.duplicate_report(spark.read.parquet(str(tmp_path / "h"))))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert keys and any(k.startswith("__hash") for k in keys)
    assert "LeftSemi" in text


@pytest.mark.parametrize("name", ["role_of_user", "authorize", "audit_table", "layer_access"])
def test_decisions_do_not_shuffle_the_requests(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert not re.search(r"Exchange hashpartitioning\(user_id", text)


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    """In the whole plan: target rows are never exchanged, nor target keys that the source lacks."""
    spark.range(10_000).selectExpr("id AS k", "uuid() AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame(pa.table({"k": [1, 10**6], "v": ["x", "y"]}))
    history_table = history.scd2_start(target, "2024-01-01 00:00:00")
    for df in (history.upsert(target, source, ["k"]), history.scd2_apply(history_table, source, ["k"], "2024-01-02 00:00:00")):
        text = plan(df)
        assert "SortAggregate" not in text and "SortMergeJoin" not in text
        for found in re.finditer(r"Exchange (\w+)[^\n]*\n((?:[^\n]*\n)*?)[^\n]*FileScan", text):
            between = found.group(2)
            assert "LeftSemi" in between or "BroadcastExchange" in found.group(0) or "Union" in between, found.group(0)


def test_conditions_need_an_equality(spark):
    good = ["target.k = source.k", "source.k = target.k AND target.v < source.v", "(target.v < 1 OR source.v > 2) AND target.`a b`==source.k".replace("`a b`", "`ab`")]
    bad = ["target.v < source.v", "target.k = target.v", "target.k = source.k OR target.v = source.v", "NOT (target.k = source.k)", "target.k = 5 AND source.k = 5"]
    assert all(map(history.has_equality, good)) and not any(map(history.has_equality, bad))
    t = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="needs a term"):  # neither an equality nor a range
        history.upsert_where(t, t, "target.v < source.v", ["k"])
