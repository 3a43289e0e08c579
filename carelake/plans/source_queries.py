"""Files, landings, layers and feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import schemas
from carelake.columns import refs
from carelake.operators import cleaning, gold, quality
from carelake.plans import flows, inputs, staging
from carelake.plans.batch_queries import (
    _DIAGNOSIS_SQL,
    _MASK_SQL,
    _PRESSURE_SQL,
    _ROUNDED,
    _STATE_SQL,
    _round_sql,
)
from carelake.plans.inputs import ENC_SQL, SILVER_SQL
from carelake.plans.registry import register, rounded
from carelake.session import fresh_path
from carelake.sources import feeds, readers, writers
from carelake.sources.writers import LakeLayout

# -- files -----------------------------------------------------------------------------------------


def _register_roundtrip(fmt):
    @register(f"roundtrip_{fmt}", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
    def _(spark, sf_dir):
        rows = inputs.table(spark, sf_dir, "customer")
        path = fresh_path(spark, fmt)
        if fmt == "csv":
            rows.write.csv(path, header=True)
        else:
            rows.write.format(fmt).save(path)
        return readers.read_file(spark, path, fmt, schema=None if fmt == "parquet" else rows.schema)


for _fmt in readers.FORMATS:
    _register_roundtrip(_fmt)


@register(
    "csv_inferred_types",
    "SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def _(spark, sf_dir):
    path = fresh_path(spark, "csv")
    inputs.table(spark, sf_dir, "customer").write.csv(path, header=True)
    return readers.read_csv(spark, path)


@register("paired_landing", f"SELECT * FROM ({ENC_SQL})")
def _(spark, sf_dir):
    rows = inputs.encounters(spark, sf_dir)
    text = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    root = fresh_path(spark, "pair")
    csv, json = writers.write_pair(text, f"{root}/a.csv", f"{root}/b.jsonl", f"{root}/scratch")
    parts = [readers.read_csv(spark, csv, text.schema), readers.read_json(spark, json, text.schema)]
    return cleaning.stack(*[cleaning.with_event_instant(p) for p in parts])


@register("response_body", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer")
def _(spark, sf_dir):
    """One response body for each nation, a JSON array of its customers."""
    rows = inputs.table(spark, sf_dir, "customer")
    one = F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    bodies = rows.groupBy("c_nationkey").agg(F.to_json(F.collect_list(one)).alias("body"))
    path = fresh_path(spark, "bodies")
    bodies.select("body", "c_nationkey").write.partitionBy("c_nationkey").text(path)
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string, c_nationkey int"
    return readers.read_response(spark, path, schema)


@register(
    "dated_landing",
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1",
)
def _(spark, sf_dir):
    layout = LakeLayout(fresh_path(spark, "dated"))
    writers.land_by_date(inputs.events(spark, sf_dir), layout, "bronze", "events", "ts")
    stored = writers.read_layer(spark, layout, "bronze", "events")
    return rounded(stored.groupBy("date").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value")))


@register(
    "schema_evolution",
    "SELECT s_suppkey AS key, s_name AS name, NULL::VARCHAR AS segment FROM supplier "
    "UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def _(spark, sf_dir):
    layout = LakeLayout(fresh_path(spark, "evolving"))
    old = inputs.table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    new = inputs.table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    writers.append_evolving(old, layout, "silver", "parties")
    writers.append_evolving(new, layout, "silver", "parties")
    return writers.read_layer(spark, layout, "silver", "parties", evolve=True)


@register("layer_bytes")
def _(spark, sf_dir):
    layout = staging.medallion(spark, sf_dir).layout
    return writers.layer_bytes(spark, {layer: layout.path(layer) for layer in ("bronze", "silver", "gold")})


# -- the whole flow --------------------------------------------------------------------------------


def _layer(spark, sf_dir, layer, table=flows.TABLE):
    return writers.read_layer(spark, staging.medallion(spark, sf_dir).layout, layer, table)


_LANDED = [c for c in inputs.ENCOUNTER_COLUMNS if c not in ("encounter_id", "timestamp")]
_AT = inputs.LANDED_AT_SQL
_DAY = f"CAST(CAST({_AT} AS DATE) AS VARCHAR) AS date"


@register("medallion_bronze", f'SELECT {", ".join(_LANDED)}, {_AT} AS "timestamp", {_DAY} FROM ({ENC_SQL})')
def _(spark, sf_dir):
    return _layer(spark, sf_dir, "bronze")


_MASKED = ("cpf", "patient_id", "nome", "email", "telefone")
_DERIVED = ("sistolica", "diastolica", "categoria_pressao", "categoria_fc", "febre")


@register(
    "medallion_silver",
    "SELECT " + ", ".join(f"{_MASK_SQL[c]} AS {c}" if c in _MASKED else c for c in (*_LANDED, *_DERIVED))
    + f", CAST(epoch(TIMESTAMP '{inputs.AS_OF}') - epoch({_AT}) AS BIGINT) * 1000 AS processing_lag_ms, "
    f'{_AT} AS "timestamp", {_DAY} FROM ({SILVER_SQL})',
)
def _(spark, sf_dir):
    names = (*_LANDED, *_DERIVED, "processing_lag_ms", "timestamp", "date")
    return _layer(spark, sf_dir, "silver").select(*refs(names))


@register("medallion_gold", _round_sql(_DIAGNOSIS_SQL, _ROUNDED))
def _(spark, sf_dir):
    return rounded(_layer(spark, sf_dir, "gold", "por_diagnostico"))


@register("medallion_gold_states", _STATE_SQL)
def _(spark, sf_dir):
    return rounded(_layer(spark, sf_dir, "gold", "por_estado"))


@register("medallion_gold_pressure", _PRESSURE_SQL)
def _(spark, sf_dir):
    return rounded(_layer(spark, sf_dir, "gold", "por_pressao"))


@register(
    "medallion_audit",
    "SELECT * FROM (VALUES ('admin', 'admin', 'write', 'bronze', true), ('admin', 'admin', 'read', 'bronze', true), "
    "('admin', 'admin', 'write', 'silver', true)) a(user_id, role, action, resource, authorized) WHERE (SELECT count(*) FROM orders) > 0",
)
def _(spark, sf_dir):
    """The guarded steps of the flow over all encounters."""
    return _layer(spark, sf_dir, "ops", "audit").select("user_id", "role", "action", "resource", "authorized")


@register("medallion_feeds", inputs.STATES_SQL)
def _(spark, sf_dir):
    path = staging.medallion(spark, sf_dir).layout.path("bronze", "feeds") + "/api_estados_ibge.json"
    return readers.read_json(spark, path, "estado_id int, sigla string, nome_estado string, regiao string")


@register(
    "medallion_quality",
    f"SELECT 'bronze' AS stage, count(*) AS total_records, count(*) FILTER (diagnostico IS NULL) AS null_diagnostico FROM ({ENC_SQL}) "
    f"UNION ALL SELECT 'silver', count(*), count(*) FILTER (diagnostico IS NULL) FROM ({SILVER_SQL})",
)
def _(spark, sf_dir):
    reports = [_layer(spark, sf_dir, "ops", f"quality/{layer}") for layer in ("bronze", "silver")]
    both = cleaning.stack(*reports)
    nulls = F.col("null_columns")["diagnostico"].alias("null_diagnostico")
    return both.select("stage", "total_records", nulls)


@register(
    "medallion_run_log",
    f"SELECT 'feeds' AS stage, count(*) AS records FROM nation UNION ALL SELECT 'ingest', count(*) FROM ({ENC_SQL}) UNION ALL SELECT 'silver', count(*) FROM ({SILVER_SQL}) "
    f"UNION ALL SELECT 'gold', (SELECT count(DISTINCT coalesce(diagnostico, '')) + count(DISTINCT estado) + count(DISTINCT categoria_pressao) FROM ({SILVER_SQL}))",
)
def _(spark, sf_dir):
    return _layer(spark, sf_dir, "ops", "runs").select("stage", "records")


@register(
    "medallion_gauges",
    f"SELECT 'active_records' AS metric, 'bronze' AS layer, count(*)::DOUBLE AS value FROM ({ENC_SQL}) "
    f"UNION ALL SELECT 'active_records', 'silver', count(*)::DOUBLE FROM ({SILVER_SQL}) "
    f"UNION ALL SELECT 'duplicate_ratio', 'bronze', round(1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({ENC_SQL}))) / count(*), 4) FROM ({ENC_SQL}) "
    "UNION ALL SELECT 'duplicate_ratio', 'silver', 0 FROM (SELECT count(*) FROM orders)",
)
def _(spark, sf_dir):
    layers = {layer: _layer(spark, sf_dir, layer) for layer in ("bronze", "silver")}
    whole = quality.gauges(layers).where("column IS NULL").select("metric", "layer", "value")
    return rounded(whole)


# -- feeds -----------------------------------------------------------------------------------------


def _parsed(rows, schema):
    """Rows as JSON payload text, parsed back under the feed's schema."""
    text = rows.select(F.to_json(F.struct(*refs(rows.columns))).alias("body"))
    return text.select(F.from_json("body", schema).alias("p")).select("p.*")


_FEED_STATES = (
    "SELECT c_custkey::INT AS estado_id, c_mktsegment AS sigla, c_name AS nome_estado, n_name AS regiao "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
)


@register("feed_states", _FEED_STATES)
def _(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer")
    nations = inputs.table(spark, sf_dir, "nation")
    payload = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS id", "c_mktsegment AS sigla", "c_name AS nome", "named_struct('nome', n_name) AS regiao"
    )
    return feeds.states(_parsed(payload, schemas.STATE_PAYLOAD))


_FEED_SUMMARY = (
    "SELECT CASE WHEN c_nationkey = 0 THEN 'Brazil' ELSE c_name END AS pais, count(*) AS casos_total, "
    "count(*) FILTER (o_orderstatus = 'F') AS mortes_total, "
    "CASE WHEN count(*) FILTER (o_orderstatus = 'P') > 2 THEN count(*) FILTER (o_orderstatus = 'P') ELSE 0 END AS recuperados, "
    "count(*) FILTER (o_orderstatus = 'O') AS ativos, round(max(o_totalprice), 2) AS casos_por_milhao, 0.0::DOUBLE AS mortes_por_milhao, "
    "0::BIGINT AS testes_total, 0::BIGINT AS populacao, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS data_atualizacao "
    "FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name, c_nationkey"
)


def summary(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer")
    orders = inputs.table(spark, sf_dir, "orders")
    totals = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(F.col("o_orderstatus") == "F").alias("deaths"),
        F.count_if(F.col("o_orderstatus") == "P").alias("p"),
        F.count_if(F.col("o_orderstatus") == "O").alias("active"),
        F.round(F.max("o_totalprice"), 2).alias("casesPerOneMillion"),
        F.unix_millis(F.max("o_orderdate").cast("timestamp")).alias("updated"),
    )
    payload = customers.join(totals, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
        "CASE WHEN c_nationkey <> 0 THEN c_name END AS country",
        "cases",
        "deaths",
        "CASE WHEN p > 2 THEN p END AS recovered",
        "active",
        "casesPerOneMillion",
        "updated",
    )
    return feeds.summary(_parsed(payload, schemas.SUMMARY_PAYLOAD))


@register("feed_summary", _FEED_SUMMARY)
def _(spark, sf_dir):
    return summary(spark, sf_dir)


@register(
    "fatality_rate",
    "SELECT pais, casos_total, mortes_total, recuperados, round(mortes_total / casos_total * 100, 2) AS taxa_mortalidade "
    f"FROM ({_FEED_SUMMARY})",
)
def _(spark, sf_dir):
    return gold.fatality(summary(spark, sf_dir))


_FEED_TIMELINE = (
    "SELECT o_orderpriority AS serie, strftime(o_orderdate, '%-m/%-d/%y') AS data, count(*) AS casos_acumulados, "
    "count(*) FILTER (o_orderstatus = 'F') AS mortes_acumuladas, count(*) FILTER (o_orderstatus = 'P') AS recuperados_acumulados "
    "FROM orders GROUP BY o_orderpriority, o_orderdate"
)


def timeline(spark, sf_dir):
    """One payload per order priority; its maps hold one entry per calendar day."""
    day = F.date_format("o_orderdate", "M/d/yy").alias("day")
    daily = inputs.table(spark, sf_dir, "orders").groupBy("o_orderpriority", day).agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(F.col("o_orderstatus") == "F").alias("deaths"),
        F.count_if(F.col("o_orderstatus") == "P").alias("recovered"),
    )

    def entries(series):
        some = F.when(F.col(series) > 0, F.struct("day", series))
        return F.map_from_entries(F.collect_list(some)).alias(series)

    maps = daily.groupBy("o_orderpriority").agg(*[entries(s) for s in ("cases", "deaths", "recovered")])
    body = F.to_json(F.struct(F.struct("cases", "deaths", "recovered").alias("timeline")))
    payload = F.from_json(body, schemas.TIMELINE_PAYLOAD)
    parsed = maps.select(F.col("o_orderpriority").alias("serie"), payload["timeline"].alias("timeline"))
    return feeds.timeline(parsed, "serie")


@register("feed_timeline", _FEED_TIMELINE)
def _(spark, sf_dir):
    return timeline(spark, sf_dir)


@register(
    "timeline_sorted",
    f"SELECT data, casos_acumulados, mortes_acumuladas FROM ({_FEED_TIMELINE})",
)
def _(spark, sf_dir):
    return gold.timeline(timeline(spark, sf_dir))


@register(
    "feed_faults",
    "SELECT n_name AS pais, count(*) AS casos_total, (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0 "
    "AND n_nationkey IN (SELECT c_nationkey FROM customer)) AS broken FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "WHERE n_nationkey % 5 <> 0 GROUP BY n_name",
)
def _(spark, sf_dir):
    """One payload for each nation, every fifth of them cut off: the others are loaded."""
    customers = inputs.table(spark, sf_dir, "customer")
    nations = inputs.table(spark, sf_dir, "nation")
    counted = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name")
    body = F.to_json(F.struct(F.col("n_name").alias("country"), "cases"))
    cut = F.when(F.col("n_nationkey") % 5 == 0, F.substring(body, 1, 12)).otherwise(body)
    payloads = counted.agg(F.count(F.lit(1)).alias("cases")).select(cut.alias("value"), "n_nationkey")
    path = fresh_path(spark, "payloads")
    payloads.write.partitionBy("n_nationkey").text(path)
    load = feeds.read_feed(spark, "covid_brasil", path)
    return load.rows.select("pais", "casos_total").withColumn("broken", F.lit(load.broken).cast("bigint"))


@register("feeds_landed", _FEED_SUMMARY)
def _(spark, sf_dir):
    """Feeds with rows are landed under their names, empty ones are not."""
    rows = {"covid_brasil": summary(spark, sf_dir), "estados_ibge": spark.createDataFrame([], schemas.STATE_PAYLOAD)}
    written = feeds.land_feeds(rows, fresh_path(spark, "feeds"))
    assert list(written) == ["covid_brasil"]
    return readers.read_json(spark, written["covid_brasil"], rows["covid_brasil"].schema)
