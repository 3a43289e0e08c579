"""Gold from sums by day equals Gold from all of Silver, whatever days change."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import gold_daily
from carelake.plans import flows
from carelake.sources import writers
from carelake.sources.writers import LakeLayout
from helpers import rows

FIRST, SECOND = date(2024, 1, 15), date(2024, 1, 16)


def land(spark, people, settings, tmp_path, day, **changes):
    moved = people.withColumn("timestamp", F.concat(F.lit(str(day)), F.substring("timestamp", 11, 9))).withColumns(changes)
    pair = writers.write_pair(moved, str(tmp_path / "a.csv"), str(tmp_path / "b.jsonl"))
    flows.ingest(spark, settings, *pair, schema=schemas.ENCOUNTER)


def gold(spark, settings):
    names = flows.GOLD_TABLES
    return {name: rows(writers.read_layer(spark, settings.layout, "gold", name)) for name in names}


def test_refreshed_days_equal_the_full_computation(spark, people, tmp_path):
    s = flows.FlowSettings(LakeLayout(str(tmp_path / "lake")), "key", "run", as_of="2024-02-01 00:00:00")
    for day in (FIRST, SECOND):
        land(spark, people, s, tmp_path, day)
    flows.build_silver(spark, s)
    flows.store_gold_by_day(spark, s)
    by_day = gold(spark, s)
    flows.store_gold(spark, s)
    assert gold(spark, s) == by_day
    land(spark, people, s, tmp_path, SECOND, heart_rate=F.lit(101), diagnostico=F.lit(None).cast("string"))
    flows.refresh_days(spark, s, [SECOND])
    refreshed = gold(spark, s)
    flows.build_silver(spark, s)
    flows.store_gold(spark, s)
    assert gold(spark, s) == refreshed != by_day
    assert (None, 4) in [r[:2] for r in refreshed["por_diagnostico"]]


def test_refresh_reads_and_replaces_its_days_only(spark, people, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    timed = people.withColumn("timestamp", F.to_timestamp("timestamp")).withColumns(
        {"sistolica": F.lit(1), "diastolica": F.lit(None).cast("int"), "categoria_pressao": F.lit("alta")}
    )
    later = timed.withColumn("timestamp", F.expr("timestamp + INTERVAL 1 DAY"))
    writers.land_by_date(timed.unionByName(later), layout, "silver", "t")
    with pytest.raises(AnalysisException):
        gold_daily.store_partials(spark, layout, "t", [SECOND])
    assert gold_daily.store_partials(spark, layout, "t") == list(gold_daily.ROLLUPS)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/gold").rglob(f"date={FIRST}/*.parquet")}
    writers.land_by_date(later.where("heart_rate > 90"), layout, "silver", "t")
    gold_daily.store_partials(spark, layout, "t", [SECOND, date(2030, 1, 1)])
    assert kept and {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/gold").rglob(f"date={FIRST}/*.parquet")} == kept
    # no value of diastolica: no mean; a day without rows adds no group
    assert rows(gold_daily.read_gold(spark, layout, "por_pressao")) == [("alta", 6, 1.0, None)]
    silver = writers.read_layer(spark, layout, "silver", "t").where(gold_daily.on_days([SECOND]))
    plan = gold_daily.partials(silver, gold_daily.ROLLUPS["por_pressao"])._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(date" in plan and "heart_rate" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_rows_without_a_day_and_without_rows(spark):
    schema = "date date, estado string, heart_rate int, categoria_pressao string"
    rollup = gold_daily.ROLLUPS["por_estado"]
    data = [(None, "PE", 70, "alta"), (FIRST, "PE", None, None), (FIRST, None, 50, "baixa")]
    silver = spark.createDataFrame(data, schema)
    folded = gold_daily.fold(gold_daily.partials(silver, rollup), rollup)
    assert rows(folded) == [("PE", 2, 70.0, 1), (None, 1, 50.0, 0)]
    assert silver.where(gold_daily.on_days([None])).count() == 1
    assert silver.where(gold_daily.on_days([FIRST])).count() == 2
    assert rows(gold_daily.fold(gold_daily.partials(silver.limit(0), rollup), rollup)) == []
