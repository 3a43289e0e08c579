import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans import flows
from carelake.sources import writers
from carelake.sources.writers import LakeLayout
from helpers import rows


@pytest.fixture
def landing(spark, people, tmp_path):
    return writers.write_pair(people, str(tmp_path / "a.csv"), str(tmp_path / "b.jsonl"))


def settings(tmp_path, user="admin"):
    return flows.FlowSettings(LakeLayout(str(tmp_path / "lake")), "key", "run-1", user, "2024-02-01 00:00:00")


def test_whole_flow(spark, landing, tmp_path):
    s = settings(tmp_path)
    stream = str(tmp_path / "landed")
    extra = [("PAC-9", "1", "Eva Sol", "170/100", 110, 39.0, 90, "2024-01-16 08:00:00")]
    spark.createDataFrame(extra, schemas.STREAM_EVENT).write.parquet(stream)
    gold = flows.run(spark, s, *landing, schema=schemas.ENCOUNTER, streamed_path=stream, connection={"url": "jdbc:none:x"})
    assert set(gold) == {"por_diagnostico", "por_estado", "por_pressao"}
    assert dict(rows(gold["por_pressao"], "categoria_pressao", "total")) == {"alta": 2, "baixa": 1, "normal": 2}
    silver = writers.read_layer(spark, s.layout, "silver", flows.TABLE)
    assert silver.count() == 5 and all(len(r[0]) == 64 for r in silver.select("patient_id").collect())
    assert {"processing_lag_ms", "record_size_bytes", "date"} <= set(silver.columns)
    log = writers.read_layer(spark, s.layout, "ops", "runs")
    assert dict(rows(log, "stage", "records")) == {"ingest": 5, "silver": 5, "gold": 5 + 5 + 3, "publish": None}
    sizes = dict(rows(spark.read.parquet(s.layout.path("ops", "storage")), "layer", "size_bytes"))
    assert set(sizes) == {"bronze", "silver", "gold"} and all(sizes.values())
    reports = spark.read.parquet(s.layout.path("ops", "quality/bronze"))
    assert rows(reports, "total_records", "duplicates") == [(5, 1)]
    audit = spark.read.parquet(s.layout.path("ops", "audit"))
    assert rows(audit, "user_id", "action", "resource", "authorized") == [("admin", "read", "bronze", True), ("admin", "write", "silver", True)]
    published = spark.read.parquet(s.layout.path("ops", "published"))
    assert published.count() == 3 and published.where("failure IS NULL").count() == 0
    assert rows(log.where("stage = 'publish'"), "error_type") == [("PublishFailure",)]


def test_runs_of_different_days_are_both_kept(spark, people, tmp_path):
    s = settings(tmp_path)
    for day in ("2024-01-15", "2024-01-16"):
        moved = people.withColumn("timestamp", F.concat(F.lit(day), F.substring("timestamp", 11, 9)))
        pair = writers.write_pair(moved, str(tmp_path / f"{day}.csv"), str(tmp_path / f"{day}.jsonl"))
        flows.run(spark, s, *pair, schema=schemas.ENCOUNTER)
    for layer, each in (("bronze", 5), ("silver", 4)):
        days = writers.read_layer(spark, s.layout, layer, flows.TABLE).groupBy("date").count()
        assert [n for _, n in rows(days.selectExpr("cast(date AS string)", "count"))] == [each, each]
    assert spark.read.parquet(s.layout.path("ops", "quality/silver")).count() == 2


def test_feeds_are_landed_by_the_flow(spark, landing, tmp_path):
    s = settings(tmp_path)
    (tmp_path / "states.json").write_text('[{"id": 1, "sigla": "PE", "nome": "x", "regiao": {"nome": "y"}}]')
    flows.run(spark, s, *landing, schema=schemas.ENCOUNTER, feed_paths={"estados_ibge": str(tmp_path / "states.json")})
    assert spark.read.json(s.layout.path("bronze", "feeds") + "/api_estados_ibge.json").count() == 1
    noted = spark.read.parquet(s.layout.path("ops", "feeds"))
    assert dict(rows(noted, "feed", "broken_records")) == {"estados_ibge": 0, "covid_brasil": 0, "covid_historico": 0}
    assert noted.where("failure = 'no path'").count() == 2


def test_flow_needs_permission(spark, landing, tmp_path):
    with pytest.raises(PermissionError):
        flows.run(spark, settings(tmp_path, "nobody"), *landing, schema=schemas.ENCOUNTER)
    log = spark.read.parquet(settings(tmp_path).layout.path("ops", "runs"))
    assert rows(log, "stage", "error_type") == [("ingest", "PermissionError")]
    audit = spark.read.parquet(settings(tmp_path).layout.path("ops", "audit"))
    assert rows(audit, "user_id", "authorized") == [("nobody", False)]


def test_inferred_schemas_meet(spark, landing, tmp_path):
    """CSV inference finds a timestamp where JSON gives text; both end up as one timestamp column."""
    s = settings(tmp_path)
    assert flows.ingest(spark, s, *landing).rows == 5
    bronze = writers.read_layer(spark, s.layout, "bronze", flows.TABLE)
    assert dict(bronze.dtypes)["timestamp"] == "timestamp"
    assert bronze.where("timestamp IS NULL").count() == 0


def test_publishing_failures_are_reported(spark, people):
    outcome = flows.publish({"gold_diagnostico": people}, {"url": "jdbc:none:x", "driver": "no.such.Driver"})
    assert "no.such.Driver" in outcome["gold_diagnostico"]
