"""Cleaning, enrichment, masking, Gold, reporting and quality over the encounter projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import refs
from carelake.functions import records
from carelake.operators import cleaning, gold, quality
from carelake.plans import inputs
from carelake.plans.inputs import AS_OF, CLEAN_SQL, ENC_SQL, KEY, SILVER_SQL, STATES_SQL, encounters
from carelake.plans.registry import register, rounded


def silver(spark, sf_dir):
    return cleaning.to_silver(encounters(spark, sf_dir), as_of=AS_OF).drop("processing_time")


# -- cleaning and enrichment -----------------------------------------------------------------------


@register("clean_encounters", f"SELECT *, TIMESTAMP '{AS_OF}' AS processing_time FROM ({CLEAN_SQL})")
def _(spark, sf_dir):
    return cleaning.clean(encounters(spark, sf_dir), AS_OF)


@register("required_fields", f'SELECT * FROM ({ENC_SQL}) WHERE patient_id IS NOT NULL AND "timestamp" IS NOT NULL')
def _(spark, sf_dir):
    return cleaning.require(encounters(spark, sf_dir))


@register("distinct_rows", f"SELECT DISTINCT * FROM ({ENC_SQL})")
def _(spark, sf_dir):
    return cleaning.distinct_rows(encounters(spark, sf_dir))


@register("distinct_keys", f"SELECT DISTINCT patient_id, diagnostico FROM ({ENC_SQL})")
def _(spark, sf_dir):
    return cleaning.distinct_keys(encounters(spark, sf_dir), ["patient_id", "diagnostico"])


@register(
    "union_by_name",
    "SELECT c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, NULL::INT AS size FROM customer "
    "UNION ALL SELECT s_name, NULL, s_acctbal, NULL FROM supplier UNION ALL SELECT p_name, p_brand, NULL, p_size FROM part",
)
def _(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer").selectExpr(
        "c_name name", "c_mktsegment segment", "c_acctbal balance"
    )
    suppliers = inputs.table(spark, sf_dir, "supplier").selectExpr("s_acctbal balance", "s_name name")
    parts = inputs.table(spark, sf_dir, "part").selectExpr("p_size size", "p_name name", "p_brand segment")
    return cleaning.stack(customers, suppliers, parts)


@register("enrich_vitals", inputs.enriched_sql(ENC_SQL))
def _(spark, sf_dir):
    return cleaning.enrich(encounters(spark, sf_dir))


@register(
    "enrich_partial_columns",
    "SELECT encounter_id, blood_pressure, sistolica, diastolica, categoria_pressao "
    f"FROM ({inputs.enriched_sql(ENC_SQL)})",
)
def _(spark, sf_dir):
    return cleaning.enrich(encounters(spark, sf_dir).select("encounter_id", "blood_pressure"))


@register(
    "silver_masked",
    "SELECT encounter_id, encode_id AS patient_id, left(email, 1) || '***@' || nullif(split_part(email, '@', 2), '') AS email, "
    "categoria_pressao, categoria_fc, febre FROM "
    f"(SELECT *, sha256(concat(patient_id, '{KEY}')) AS encode_id FROM ({SILVER_SQL}))",
)
def _(spark, sf_dir):
    rows = cleaning.to_silver(encounters(spark, sf_dir), KEY, AS_OF)
    return rows.select("encounter_id", "patient_id", "email", "categoria_pressao", "categoria_fc", "febre")


# -- masking ---------------------------------------------------------------------------------------

_MASK_SQL = {
    "cpf": "concat('***', substr(cpf, 5, 3), '***')",
    "patient_id": f"CASE WHEN patient_id IS NOT NULL THEN sha256(concat(patient_id, '{KEY}')) END",
    "nome": "concat(left(nome, 1), '***_', left(sha256(nome), 6))",
    "email": "CASE WHEN contains(email, '@') THEN concat(left(email, 1), '***@', split_part(email, '@', 2)) END",
    "telefone": "concat('(**) *****-', right(telefone, 4))",
    "cidade": r"regexp_replace(cidade, '(^.{3}).*', '\1***')",
    "medicamento": r"regexp_replace(medicamento, '(^.{3}).*', '\1***')",
}


def _register_mask(name, column):
    @register(name, f"SELECT encounter_id, {_MASK_SQL[column]} AS {column} FROM ({ENC_SQL})")
    def _(spark, sf_dir):
        rows = encounters(spark, sf_dir).select("encounter_id", column)
        return cleaning.mask_column(rows, column, KEY)


for _name, _column in {
    "mask_cpf": "cpf",
    "mask_id": "patient_id",
    "mask_name": "nome",
    "mask_email": "email",
    "mask_phone": "telefone",
    "mask_generic": "cidade",
    "mask_generic_short": "medicamento",
}.items():
    _register_mask(_name, _column)


@register(
    "mask_generic_strict",
    "SELECT encounter_id, CASE WHEN length(medicamento) < 3 THEN '***' ELSE "
    + _MASK_SQL["medicamento"]
    + f" END AS medicamento FROM ({ENC_SQL})",
)
def _(spark, sf_dir):
    rows = encounters(spark, sf_dir).select("encounter_id", "medicamento")
    return cleaning.mask_column(rows, "medicamento", KEY, strict=True)


@register(
    "mask_all",
    f"SELECT * REPLACE ({', '.join(f'{_MASK_SQL[c]} AS {c}' for c in fx.SENSITIVE_FIELDS)}) FROM ({ENC_SQL})",
)
def _(spark, sf_dir):
    return cleaning.mask_sensitive(encounters(spark, sf_dir), KEY)


@register(
    "masked_groups",
    f"SELECT {_MASK_SQL['nome']} AS nome, {_MASK_SQL['email']} AS email, count(*) AS encounters "
    f"FROM ({ENC_SQL}) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    rows = encounters(spark, sf_dir).select("nome", "email")
    masked = cleaning.mask_sensitive(rows, KEY)
    return masked.groupBy("nome", "email").agg(F.count(F.lit(1)).alias("encounters"))


# -- record functions ------------------------------------------------------------------------------


def _mod11_sql(digits, size):
    total = " + ".join(f"CAST(substr({digits}, {i}, 1) AS INT) * {size + 2 - i}" for i in range(1, size + 1))
    return f"(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END)::VARCHAR"


@register(
    "cpf_check",
    "SELECT c_custkey, cpf, d1 || d2 AS check_digits, substr(body, 10, 2) = d1 || d2 AS valid FROM ("
    f"SELECT *, {_mod11_sql('(substr(body, 1, 9) || d1)', 10)} AS d2 FROM ("
    f"SELECT *, {_mod11_sql('body', 9)} AS d1 FROM ("
    "SELECT c_custkey, cpf, replace(replace(cpf, '.', ''), '-', '') AS body FROM ("
    "SELECT c_custkey, concat(substr(n, 1, 3), '.', substr(n, 4, 3), '.', substr(n, 7, 3), '-', substr(n, 10, 2)) AS cpf "
    "FROM (SELECT c_custkey, lpad(CAST((c_custkey * 7919 + 12345) % 99999999999 AS VARCHAR), 11, '0') AS n FROM customer)))))",
)
def _(spark, sf_dir):
    number = "lpad(CAST((c_custkey * 7919 + 12345) % 99999999999 AS VARCHAR(20)), 11, '0')"
    formatted = F.regexp_replace(F.expr(number), r"(\d{3})(\d{3})(\d{3})(\d{2})", "$1.$2.$3-$4")
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", formatted.alias("cpf"))
    body = F.substring(F.regexp_replace("cpf", r"\D", ""), 1, 9)
    return rows.select(
        "*", records.check_digits(body).alias("check_digits"), records.cpf_is_valid(F.col("cpf")).alias("valid")
    )


@register(
    "parse_event_time",
    "SELECT o_orderkey, o_orderdate AS event_time, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders",
)
def _(spark, sf_dir):
    text = F.date_format("o_orderdate", fx.TEXT_TIMESTAMP_FORMAT)
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("timestamp"))
    parsed = cleaning.with_event_instant(rows)
    return parsed.select("o_orderkey", F.col("timestamp").alias("event_time"), F.to_date("timestamp").alias("date"))


@register(
    "processing_lag",
    f"SELECT event_id, CAST(epoch(TIMESTAMP '{inputs.EVENTS_AS_OF}') - floor(epoch(ts)) AS BIGINT) * 1000 AS processing_lag_ms FROM events",
)
def _(spark, sf_dir):
    lag = records.lag_ms(F.lit(inputs.EVENTS_AS_OF).cast("timestamp"), F.col("ts"))
    return inputs.events(spark, sf_dir).select("event_id", lag.alias("processing_lag_ms"))


@register(
    "record_size",
    "SELECT event_id, lag AS processing_lag_ms, length(CAST(json_object('event_id', event_id, 'user_id', user_id, "
    "'event_type', event_type, 'props', props, 'timestamp', strftime(ts, '%Y-%m-%d %H:%M:%S'), "
    "'processing_lag_ms', lag) AS VARCHAR))::INT AS record_size_bytes FROM (SELECT *, CAST(epoch(TIMESTAMP "
    f"'{inputs.EVENTS_AS_OF}') - floor(epoch(ts)) AS BIGINT) * 1000 AS lag FROM events)",
)
def _(spark, sf_dir):
    text = F.date_format("ts", fx.TEXT_TIMESTAMP_FORMAT).alias("timestamp")
    rows = inputs.events(spark, sf_dir).select("event_id", "user_id", "event_type", "props", text)
    measured = cleaning.add_record_metrics(rows, inputs.EVENTS_AS_OF)
    return measured.select("event_id", "processing_lag_ms", "record_size_bytes")


# -- Gold ------------------------------------------------------------------------------------------

_MEANS = ("heart_rate", "media_freq_cardiaca"), ("sistolica", "media_sistolica"), ("diastolica", "media_diastolica")
_DIAGNOSIS_SQL = (
    "SELECT diagnostico, count(*) AS total_pacientes, "
    + ", ".join(f"avg({c}) AS {name}" for c, name in _MEANS)
    + f", avg(temperatura) AS media_temperatura FROM ({SILVER_SQL}) GROUP BY diagnostico"
)
_ROUNDED = ("media_freq_cardiaca", "media_sistolica", "media_diastolica", "media_temperatura")


def _round_sql(sql, columns, digits=4):
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in columns)}) FROM ({sql})"


def gold_frame(spark, sf_dir):
    return gold.by_diagnosis(silver(spark, sf_dir))


@register("gold_by_diagnosis", _round_sql(_DIAGNOSIS_SQL, _ROUNDED))
def gold_by_diagnosis(spark, sf_dir):
    return rounded(gold.ranked(gold_frame(spark, sf_dir), "total_pacientes", "diagnostico"))


_STATE_SQL = (
    "SELECT estado, count(*) AS total_pacientes, round(avg(heart_rate), 4) AS media_freq_cardiaca, "
    f"count(*) FILTER (categoria_pressao = 'alta') AS pacientes_pressao_alta FROM ({SILVER_SQL}) GROUP BY estado"
)
_PRESSURE_SQL = (
    "SELECT categoria_pressao, count(*) AS total, round(avg(sistolica), 4) AS media_sistolica, "
    f"round(avg(diastolica), 4) AS media_diastolica FROM ({SILVER_SQL}) GROUP BY categoria_pressao"
)


@register("gold_by_state", _STATE_SQL)
def _(spark, sf_dir):
    return rounded(gold.ranked(gold.by_state(silver(spark, sf_dir)), "total_pacientes", "estado"))


@register("gold_by_pressure", _PRESSURE_SQL)
def _(spark, sf_dir):
    return rounded(gold.by_pressure(silver(spark, sf_dir)))


@register(
    "gold_top10_states",
    f"SELECT * FROM ({_STATE_SQL}) ORDER BY total_pacientes DESC, estado LIMIT 10",
)
def _(spark, sf_dir):
    return rounded(gold.ranked(gold.by_state(silver(spark, sf_dir)), "total_pacientes", "estado", top=10))


@register("bi_total", f"SELECT CAST(sum(total_pacientes) AS BIGINT) AS total FROM ({_DIAGNOSIS_SQL})")
def _(spark, sf_dir):
    return gold.total_encounters(gold_frame(spark, sf_dir))


@register("bi_groups", f"SELECT count(*) AS diagnosticos FROM ({_DIAGNOSIS_SQL})")
def _(spark, sf_dir):
    return gold.group_number(gold_frame(spark, sf_dir))


@register("bi_chart", f"SELECT diagnostico, total_pacientes FROM ({_DIAGNOSIS_SQL}) WHERE diagnostico IS NOT NULL")
def _(spark, sf_dir):
    return gold.chart(gold_frame(spark, sf_dir))


@register("bi_detail", _round_sql(_DIAGNOSIS_SQL, _ROUNDED, 1))
def _(spark, sf_dir):
    return gold.detail(gold_frame(spark, sf_dir))


@register(
    "bi_high_pressure_states",
    "SELECT estado, count(*) AS total_pacientes, count(*) FILTER (categoria_pressao = 'alta') AS pacientes_pressao_alta "
    f"FROM ({SILVER_SQL}) GROUP BY estado",
)
def _(spark, sf_dir):
    ranked = gold.ranked(gold.by_state(silver(spark, sf_dir)), "pacientes_pressao_alta", "estado")
    return ranked.select("estado", "total_pacientes", "pacientes_pressao_alta")


@register("states_by_region", f"SELECT regiao, count(*) AS total_estados FROM ({STATES_SQL}) GROUP BY regiao")
def _(spark, sf_dir):
    return gold.states_per_region(inputs.state_reference(spark, sf_dir))


@register(
    "geo_enrich",
    f"SELECT e.estado, encounter_id, nome_estado, regiao FROM ({ENC_SQL}) e LEFT JOIN ({STATES_SQL}) s ON e.estado = s.sigla",
)
def _(spark, sf_dir):
    rows = encounters(spark, sf_dir).select("encounter_id", "estado")
    return gold.with_region(rows, inputs.state_reference(spark, sf_dir))


# -- quality ---------------------------------------------------------------------------------------

_COLUMNS = [
    "encounter_id", "patient_id", "cpf", "nome", "email", "telefone", "idade", "sexo", "cidade", "estado",
    "blood_pressure", "heart_rate", "temperatura", "saturacao_o2", "diagnostico", "medicamento", "timestamp",
]


def _per_column_sql(row, source, suffix=""):
    """One SELECT per column over a shared common table."""
    parts = " UNION ALL ".join(row.format(c=c, q=f'"{c}"') + " FROM src" for c in _COLUMNS)
    return f"WITH src AS MATERIALIZED ({source}) SELECT * FROM ({parts}) {suffix}"


_NULL_ROW = (
    "SELECT '{c}' AS \"column\", count(*) AS total_records, count(*) FILTER ({q} IS NULL) AS null_count, "
    "round(count(*) FILTER ({q} IS NULL) / count(*), 6) AS null_ratio, "
    "round(count(*) FILTER ({q} IS NULL) / count(*) * 100, 2) AS null_pct"
)


@register("null_profile", _per_column_sql(_NULL_ROW, ENC_SQL))
def _(spark, sf_dir):
    profile = quality.null_profile(encounters(spark, sf_dir))
    return profile.withColumn("null_ratio", F.round("null_ratio", 6))


@register(
    "quality_report",
    f"WITH src AS ({ENC_SQL}) SELECT 'bronze' AS stage, (SELECT count(*) FROM src) AS total_records, 17 AS columns, "
    "(SELECT count(*) FROM src) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS duplicates, "
    "count(*) FILTER (patient_id IS NULL) AS null_patient_id, count(*) FILTER (diagnostico IS NULL) AS null_diagnostico, "
    "count(*) FILTER (medicamento IS NULL) AS null_medicamento, "
    "round(count(*) FILTER (medicamento IS NULL) / count(*) * 100, 2) AS pct_medicamento, 3 AS columns_with_nulls FROM src",
)
def _(spark, sf_dir):
    report = quality.quality_report(encounters(spark, sf_dir), "bronze")
    counts = [F.col("null_columns")[c].alias(f"null_{c}") for c in ("patient_id", "diagnostico", "medicamento")]
    return report.select(
        "stage",
        "total_records",
        "columns",
        "duplicates",
        *counts,
        F.col("null_pct")["medicamento"].alias("pct_medicamento"),
        F.size("null_columns").alias("columns_with_nulls"),
    )


@register(
    "duplicate_report",
    f"WITH src AS ({ENC_SQL}) SELECT 'bronze' AS layer, n AS total_records, d AS distinct_records, n - d AS duplicates, "
    "round((n - d) / n, 6) AS duplicate_ratio FROM (SELECT (SELECT count(*) FROM src) AS n, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS d)",
)
def _(spark, sf_dir):
    return rounded(quality.duplicate_report(encounters(spark, sf_dir), "bronze"), 6)


@register(
    "null_alerts",
    _per_column_sql(
        "SELECT 'WARNING' AS severity, '{c}' AS \"column\", "
        "round(count(*) FILTER ({q} IS NULL) / count(*) * 100, 4) AS null_pct",
        ENC_SQL,
        "WHERE null_pct > 30",
    ),
)
def _(spark, sf_dir):
    return rounded(quality.threshold_alerts(encounters(spark, sf_dir)))


_NULL_CELLS = " + ".join(f'("{c}" IS NULL)::INT' for c in _COLUMNS)
_RULES = (
    "avg((coalesce(heart_rate BETWEEN 30 AND 220, false))::INT) + avg((coalesce(temperatura BETWEEN 34 AND 42, false))::INT) + "
    "avg((coalesce(saturacao_o2 BETWEEN 70 AND 100, false))::INT) + avg((coalesce(idade BETWEEN 0 AND 130, false))::INT) + "
    "avg((coalesce(sexo IN ('M', 'F'), false))::INT)"
)
_AGE = f"epoch(TIMESTAMP '{AS_OF}' - max(\"timestamp\")) / 3600 / 72"


@register("completeness", f"SELECT round(1 - sum({_NULL_CELLS}) / (count(*) * 17), 6) AS completeness FROM ({ENC_SQL})")
def _(spark, sf_dir):
    return rounded(quality.completeness(encounters(spark, sf_dir)), 6)


@register(
    "uniqueness_rows",
    f"WITH src AS ({ENC_SQL}) SELECT round((SELECT count(*) FROM (SELECT DISTINCT * FROM src)) / count(*), 6) AS uniqueness FROM src",
)
def _(spark, sf_dir):
    return rounded(quality.uniqueness(encounters(spark, sf_dir)), 6)


@register(
    "uniqueness_keys",
    f"WITH src AS ({ENC_SQL}) SELECT round((SELECT count(*) FROM (SELECT DISTINCT patient_id FROM src)) / count(*), 6) AS uniqueness FROM src",
)
def _(spark, sf_dir):
    return rounded(quality.uniqueness(encounters(spark, sf_dir), ["patient_id"]), 6)


@register("consistency", f"SELECT round(({_RULES}) / 5, 6) AS consistency FROM ({ENC_SQL})")
def _(spark, sf_dir):
    return rounded(quality.consistency(encounters(spark, sf_dir)), 6)


@register("latest_event", "SELECT max(ts) AS latest FROM events")
def _(spark, sf_dir):
    return quality.latest(inputs.events(spark, sf_dir), "ts")


@register("timeliness", f"SELECT round(greatest(0, 1 - {_AGE}), 6) AS timeliness FROM ({ENC_SQL})")
def _(spark, sf_dir):
    return rounded(quality.timeliness(encounters(spark, sf_dir), max_age_hours=72, as_of=AS_OF), 6)


@register(
    "dqs",
    f"WITH src AS ({ENC_SQL}), part AS (SELECT count(*) AS total_records, 1 - sum({_NULL_CELLS}) / (count(*) * 17) AS c, "
    f"(SELECT count(*) FROM (SELECT DISTINCT patient_id FROM src)) / count(*) AS u, ({_RULES}) / 5 AS k, "
    f"greatest(0, 1 - {_AGE}) AS t FROM src) SELECT 'bronze' AS layer, total_records, 17 AS total_columns, "
    "round(c, 4) AS completeness, round(u, 4) AS uniqueness, round(k, 4) AS consistency, round(t, 4) AS timeliness, "
    "round(0.30 * c + 0.25 * u + 0.25 * k + 0.20 * t, 4) AS dqs_score FROM part",
)
def _(spark, sf_dir):
    return quality.scorecard(
        encounters(spark, sf_dir), "bronze", ["patient_id"], max_age_hours=72, as_of=AS_OF
    )


def _profile_sql(table, columns):
    parts = []
    for name, numeric in columns.items():
        stats = (
            f"min({name})::DOUBLE AS min, max({name})::DOUBLE AS max, round(avg({name}), 4) AS mean, "
            f"round(stddev_samp({name}), 4) AS stddev"
            if numeric
            else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev"
        )
        distinct = f"(count(DISTINCT {name}) + max(({name} IS NULL)::INT))"
        parts.append(
            f"SELECT '{name}' AS \"column\", count(*) FILTER ({name} IS NULL) AS null_count, "
            f"round(count(*) FILTER ({name} IS NULL) / count(*) * 100, 2) AS null_pct, "
            f"{distinct}::BIGINT AS distinct_count, round({distinct} / count(*) * 100, 2) AS distinct_pct, {stats} "
            f"FROM {table}"
        )
    return " UNION ALL ".join(parts)


_LINEITEM = {
    "l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True, "l_quantity": True,
    "l_extendedprice": True, "l_discount": True, "l_tax": True, "l_returnflag": False, "l_linestatus": False,
    "l_shipdate": False,
}


@register("column_profile", _profile_sql("lineitem", _LINEITEM))
def _(spark, sf_dir):
    return quality.column_profile(inputs.table(spark, sf_dir, "lineitem"))


_NUMBERS = ("encounter_id", "idade", "heart_rate", "temperatura", "saturacao_o2", "unit")
_PROFILED = {name: name in _NUMBERS for name in (*inputs.ENCOUNTER_COLUMNS, "unit")}


@register(
    "column_profile_sketch",
    "SELECT \"column\", null_count, true AS close FROM (" + _profile_sql("lineitem", _LINEITEM) + ")",
)
def _(spark, sf_dir):
    """Estimated distinct counts lie within four times their stated error of the exact ones."""
    rows = inputs.table(spark, sf_dir, "lineitem")
    exact = quality.column_profile(rows).select("column", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))
    return quality.column_profile(rows, relative_error=0.02).join(exact, "column").select("column", "null_count", near.alias("close"))


@register("column_profile_with_nulls", _profile_sql(f"(SELECT *, 1 AS unit FROM ({ENC_SQL}))", _PROFILED))
def _(spark, sf_dir):
    rows = encounters(spark, sf_dir).withColumn("unit", F.lit(1))
    return quality.column_profile(rows.select(*refs(_PROFILED)))


@register(
    "anomalies",
    f"WITH p AS ({_profile_sql(f'(SELECT *, 1 AS unit FROM ({ENC_SQL}))', _PROFILED)}) "
    "SELECT 'high_null_ratio' AS type, \"column\", null_pct AS value, 30.0::DOUBLE AS threshold, 'warning' AS severity "
    "FROM p WHERE null_pct > 30 UNION ALL SELECT 'constant_column', \"column\", NULL, NULL, 'info' FROM p "
    "WHERE distinct_count = 1 AND null_count = 0 UNION ALL SELECT 'zero_variance', \"column\", NULL, NULL, 'warning' "
    "FROM p WHERE stddev = 0 AND distinct_count > 1",
)
def _(spark, sf_dir):
    rows = encounters(spark, sf_dir).withColumn("unit", F.lit(1))
    return quality.suspicious(rows.select(*refs(_PROFILED)))


@register(
    "gauges",
    _per_column_sql(
        "SELECT 'null_ratio' AS metric, 'bronze' AS layer, '{c}' AS \"column\", "
        "round(count(*) FILTER ({q} IS NULL) / count(*), 6) AS value",
        ENC_SQL,
        "UNION ALL SELECT 'active_records', 'bronze', NULL, count(*)::DOUBLE FROM src UNION ALL "
        "SELECT 'duplicate_ratio', 'bronze', NULL, round(1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) / count(*), 6) FROM src",
    ),
)
def _(spark, sf_dir):
    return rounded(quality.gauges({"bronze": encounters(spark, sf_dir)}), 6)
