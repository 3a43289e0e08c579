"""Frames the registered queries read: the given tables, seen as encounters, logs and requests.

The given tables hold neither nulls nor copies nor malformed text, so the projection injects some
at fixed places. The column expressions are plain SQL that Spark and the checking engine read
alike; ``*_SQL`` strings are the same projections for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
KEY = "example-key"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its file listing and schema are looked up once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _text(number: str) -> str:
    return f"CAST({number} AS VARCHAR(20))"


def _digits(number: str, size: int) -> str:
    return f"lpad({_text(number)}, {size}, '0')"


# -- encounters: an order is one encounter of a customer -----------------------------------------

_ENCOUNTER = {
    "encounter_id": "o_orderkey",
    "patient_id": f"CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('PAC-', {_digits('c_custkey', 6)}) END",
    "cpf": (
        f"concat({_digits('c_custkey % 1000', 3)}, '.', {_digits('(c_custkey * 7) % 1000', 3)}, '.', "
        f"{_digits('(c_custkey * 13) % 1000', 3)}, '-', {_digits('(c_custkey * 17) % 100', 2)})"
    ),
    "nome": "c_name",
    "email": (
        f"CASE WHEN o_orderkey % 89 = 0 THEN 'no-at-sign' "
        f"ELSE concat('user', {_text('c_custkey')}, '@', lower(c_mktsegment), '.example') END"
    ),
    "telefone": f"concat('(11) 9', {_digits('c_custkey % 10000', 4)}, '-', {_digits('o_orderkey % 10000', 4)})",
    "idade": "CAST(18 + c_custkey % 78 AS INT)",
    "sexo": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "cidade": "c_mktsegment",
    "estado": "n_name",
    "blood_pressure": (
        f"CASE WHEN o_orderkey % 101 = 0 THEN 'bad' ELSE concat({_text('80 + o_orderkey % 101')}, ' / ', "
        f"{_text('50 + (o_orderkey * 3) % 71')}) END"
    ),
    "heart_rate": "CAST(50 + (o_orderkey * 7) % 81 AS INT)",
    "temperatura": "CAST(355 + (o_orderkey * 11) % 51 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "saturacao_o2": "CAST(88 + o_orderkey % 13 AS INT)",
    "diagnostico": "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END",
    "medicamento": "CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_orderstatus END",
    "`timestamp`": "o_orderdate",
}
ENCOUNTER_COLUMNS = tuple(name.strip("`") for name in _ENCOUNTER)
# every 50th encounter is there twice
_TWICE = "o_orderkey % 50 = 0"


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters with injected nulls, malformed readings and exact copies. Copies are made by
    expanding rows in place, not by reading the tables twice."""
    copies = F.explode(F.expr(f"CASE WHEN {_TWICE} THEN array(1, 2) ELSE array(1) END"))
    orders = table(spark, sf_dir, "orders").withColumn("copy", copies)
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = joined.selectExpr(*[f"{sql} AS {name}" for name, sql in _ENCOUNTER.items()])
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


ENC_SQL = (
    "SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _ENCOUNTER.items()).replace("`timestamp`", '"timestamp"')
    + f" FROM (SELECT *, unnest(CASE WHEN {_TWICE} THEN [1, 2] ELSE [1] END) AS copy FROM orders)"
    + " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
)
CLEAN_SQL = f'SELECT DISTINCT * FROM ({ENC_SQL}) WHERE patient_id IS NOT NULL AND "timestamp" IS NOT NULL'
_SIDES_SQL = (
    "SELECT *, try_cast(split_part(replace(blood_pressure, ' ', ''), '/', 1) AS INT) AS sistolica, "
    "try_cast(split_part(replace(blood_pressure, ' ', ''), '/', 2) AS INT) AS diastolica FROM ({})"
)


def enriched_sql(rows: str) -> str:
    return (
        "SELECT *, CASE WHEN sistolica < 90 OR diastolica < 60 THEN 'baixa' "
        "WHEN sistolica >= 140 OR diastolica >= 90 THEN 'alta' ELSE 'normal' END AS categoria_pressao, "
        "CASE WHEN heart_rate < 60 THEN 'bradicardia' WHEN heart_rate > 100 THEN 'taquicardia' "
        "ELSE 'normal' END AS categoria_fc, coalesce(temperatura >= 37.8, false) AS febre "
        f"FROM ({_SIDES_SQL.format(rows)})"
    )


SILVER_SQL = enriched_sql(CLEAN_SQL)


# the landed copy of all encounters spreads them over four weeks, that is 28 date partitions
LANDED_AT = "TIMESTAMP_NTZ '2001-07-01 00:00:00' + make_dt_interval(CAST(encounter_id % 28 AS INT))"
LANDED_AT_SQL = "(TIMESTAMP '2001-07-01 00:00:00' + to_days(CAST(encounter_id % 28 AS INT)))"

# -- state reference: nations and regions --------------------------------------------------------


def state_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("estado_id"),
        F.col("n_name").alias("sigla"),
        F.concat(F.col("n_name"), F.lit(" state")).alias("nome_estado"),
        F.col("r_name").alias("regiao"),
    )


STATES_SQL = (
    "SELECT n_nationkey AS estado_id, n_name AS sigla, concat(n_name, ' state') AS nome_estado, "
    "r_name AS regiao FROM nation JOIN region ON n_regionkey = r_regionkey"
)

# -- parties: customers as the stored table, their orders and all suppliers as the load ------------

# finished orders above this sum withdraw the balance
_WITHDRAWN = 1_000_000


def party_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('C', CAST(c_custkey AS VARCHAR(20))) AS party_id",
        "c_name AS name",
        "c_nationkey AS nation",
        "c_mktsegment AS segment",
        "c_acctbal AS balance",
    )


def party_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered, with all finished orders added to their balance (or the balance
    withdrawn above a limit), and all suppliers as new parties."""
    customers = table(spark, sf_dir, "customer")
    finished = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0))
    spent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(finished.alias("spent"))
    touched = customers.join(spent, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
        "concat('C', CAST(c_custkey AS VARCHAR(20))) AS party_id",
        "c_name AS name",
        "c_nationkey AS nation",
        "c_mktsegment AS segment",
        f"CASE WHEN spent > {_WITHDRAWN} THEN NULL ELSE round(c_acctbal + spent, 2) END AS balance",
    )
    new = table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', CAST(s_suppkey AS VARCHAR(20))) AS party_id",
        "s_name AS name",
        "s_nationkey AS nation",
        "'SUPPLIER' AS segment",
        "s_acctbal AS balance",
    )
    return touched.unionByName(new)


TARGET_SQL = (
    "SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS party_id, c_name AS name, c_nationkey AS nation, "
    "c_mktsegment AS segment, c_acctbal AS balance FROM customer"
)
SOURCE_SQL = (
    "SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS party_id, c_name AS name, c_nationkey AS nation, "
    f"c_mktsegment AS segment, CASE WHEN spent > {_WITHDRAWN} THEN NULL ELSE round(c_acctbal + spent, 2) END AS balance "
    "FROM customer JOIN (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS spent "
    "FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey "
    "UNION ALL SELECT concat('S', CAST(s_suppkey AS VARCHAR)), s_name, s_nationkey, 'SUPPLIER', s_acctbal FROM supplier"
)

# -- events as stage log, access requests and vital-sign messages ----------------------------------

_LOG = {
    "run_id": "CAST(user_id AS VARCHAR(20))",
    "stage": "event_type",
    "started": "ts",
    "duration": "value",
    "records": "event_id % 1000",
    "source": "CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'streaming' END",
    "error_type": "CASE WHEN event_type = 'error' THEN concat('E', CAST(event_id % 3 AS VARCHAR(20))) END",
    "bytes_written": "(event_id * 7919) % 100000 * 10000",
    "bytes_transferred": "(event_id * 104729) % 100000 * 1000",
}
_REQUEST = {
    "timestamp": "ts",
    "user_id": (
        "CASE user_id % 5 WHEN 0 THEN 'admin' WHEN 1 THEN 'analista_01' WHEN 2 THEN 'cientista_01' "
        "WHEN 3 THEN 'visitante_01' ELSE concat('guest', CAST(user_id AS VARCHAR(20))) END"
    ),
    "action": (
        "CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'write' WHEN 'purchase' THEN 'export' "
        "WHEN 'signup' THEN 'mask' ELSE 'delete' END"
    ),
    "resource": "CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END",
    "request_id": "event_id",
}
_VITALS = {
    "patient_id": f"concat('PAC-', {_digits('user_id', 6)})",
    "cpf": f"concat({_digits('user_id % 1000', 3)}, '.000.000-00')",
    "nome": f"concat('name ', {_text('user_id')})",
    "blood_pressure": f"concat({_text('80 + event_id % 101')}, '/', {_text('50 + event_id % 71')})",
    "heart_rate": "CAST(50 + (event_id * 7) % 81 AS INT)",
    "temperatura": "CAST(355 + (event_id * 11) % 51 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "saturacao_o2": "CAST(88 + event_id % 13 AS INT)",
    "diagnostico": "event_type",
}


def _projection(columns: dict[str, str], name_quote: str) -> list[str]:
    return [f"{sql} AS {name_quote}{name}{name_quote}" for name, sql in columns.items()]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*_projection(_LOG, "`"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*_projection(_REQUEST, "`"))


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vital-sign message per event, its time as text like the exchanged records have it."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    return events(spark, sf_dir).select(*[F.expr(e) for e in _projection(_VITALS, "`")], text)


LOG_SQL = "SELECT " + ", ".join(_projection(_LOG, '"')) + " FROM events"
REQUEST_SQL = "SELECT " + ", ".join(_projection(_REQUEST, '"')) + " FROM events"
VITALS_SQL = (
    "SELECT " + ", ".join(_projection(_VITALS, '"')) + ", date_trunc('second', ts) AS event_time FROM events"
)
USERS_SQL = (
    "(VALUES ('admin', 'admin'), ('analista_01', 'analista'), ('cientista_01', 'cientista_dados'), "
    "('visitante_01', 'visitante')) u(user_id, role)"
)
ROLES_SQL = (
    "(VALUES ('admin', ['read', 'write', 'delete', 'mask', 'export']), ('analista', ['read', 'write']), "
    "('cientista_dados', ['read', 'write', 'export']), ('visitante', ['read'])) r(role, permissions)"
)
LAYERS_SQL = (
    "(VALUES ('bronze', 'admin'), ('silver', 'admin'), ('silver', 'analista'), ('gold', 'admin'), "
    "('gold', 'analista'), ('gold', 'cientista_dados'), ('gold', 'visitante')) l(layer, role)"
)
