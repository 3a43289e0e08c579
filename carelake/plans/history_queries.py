"""Upserts, history, versions, layout and subject rights."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelake.columns import ref
from carelake.operators import cleaning, history, privacy
from carelake.plans import inputs, staging
from carelake.plans.inputs import ENC_SQL, KEY, SOURCE_SQL, TARGET_SQL
from carelake.plans.registry import register
from carelake.plans.staging import T0, T1, T2, T3
from carelake.session import fresh_path
from carelake.sources import readers, tables

_FIELDS = ("name", "nation", "segment", "balance")
_UPSERT = (
    "SELECT coalesce(t.party_id, s.party_id) AS party_id, "
    + ", ".join(f"CASE WHEN s.party_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _FIELDS)
    + ", CASE WHEN t.party_id IS NULL THEN 'inserted' WHEN s.party_id IS NULL THEN 'kept' ELSE 'updated' END AS action "
    f"FROM ({TARGET_SQL}) t FULL JOIN ({SOURCE_SQL}) s ON t.party_id = s.party_id"
)


def _pair(spark, sf_dir):
    return inputs.party_target(spark, sf_dir), inputs.party_source(spark, sf_dir)


@register("upsert", _UPSERT)
def _(spark, sf_dir):
    return history.upsert(*_pair(spark, sf_dir), ["party_id"], action_column="action")


@register(
    "upsert_some_columns",
    "SELECT coalesce(t.party_id, s.party_id) AS party_id, coalesce(t.name, s.name) AS name, "
    "CASE WHEN t.party_id IS NULL THEN s.nation ELSE t.nation END AS nation, coalesce(t.segment, s.segment) AS segment, "
    "CASE WHEN s.party_id IS NOT NULL THEN s.balance ELSE t.balance END AS balance "
    f"FROM ({TARGET_SQL}) t FULL JOIN ({SOURCE_SQL}) s ON t.party_id = s.party_id",
)
def _(spark, sf_dir):
    return history.upsert(*_pair(spark, sf_dir), ["party_id"], update_columns=["balance"])


@register(
    "upsert_on_condition",
    f"WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL}) "
    "SELECT t.party_id, CASE WHEN s.party_id IS NOT NULL THEN s.name ELSE t.name END AS name, "
    "CASE WHEN s.party_id IS NOT NULL THEN s.nation ELSE t.nation END AS nation, "
    "CASE WHEN s.party_id IS NOT NULL THEN s.segment ELSE t.segment END AS segment, "
    "CASE WHEN s.party_id IS NOT NULL THEN s.balance ELSE t.balance END AS balance "
    "FROM t LEFT JOIN s ON t.party_id = s.party_id AND s.balance > t.balance UNION ALL "
    "SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.party_id = s.party_id AND s.balance > t.balance)",
)
def _(spark, sf_dir):
    condition = "target.party_id = source.party_id AND source.balance > target.balance"
    return history.upsert_where(*_pair(spark, sf_dir), condition, row_id=["party_id"])


_CHANGED = "(" + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in _FIELDS) + ")"
_COLUMNS = "party_id, " + ", ".join(_FIELDS)
_SCD2 = (
    f"WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL}), "
    f"closed AS (SELECT t.*, TIMESTAMP '{T0}' AS valid_from, TIMESTAMP '{T1}' AS valid_to, false AS is_current "
    f"FROM t JOIN s ON t.party_id = s.party_id WHERE {_CHANGED}), "
    f"same AS (SELECT t.*, TIMESTAMP '{T0}', NULL::TIMESTAMP, true FROM t WHERE party_id NOT IN (SELECT party_id FROM closed)), "
    f"fresh AS (SELECT s.*, TIMESTAMP '{T1}', NULL::TIMESTAMP, true FROM s LEFT JOIN t ON t.party_id = s.party_id "
    f"WHERE t.party_id IS NULL OR {_CHANGED}) "
    "SELECT * FROM closed UNION ALL SELECT * FROM same UNION ALL SELECT * FROM fresh"
)


@register("scd2_apply", _SCD2)
def _(spark, sf_dir):
    return staging.party_history(spark, sf_dir)


@register("scd2_replay", _SCD2)
def _(spark, sf_dir):
    """Loading the same rows a second time changes nothing."""
    once = staging.party_history(spark, sf_dir)
    return history.scd2_apply(once, inputs.party_source(spark, sf_dir), ["party_id"], T2)


@register("scd2_current", f"SELECT * FROM ({_SCD2}) WHERE is_current")
def _(spark, sf_dir):
    return history.scd2_current(staging.party_history(spark, sf_dir))


@register(
    "scd2_as_of",
    f"SELECT * FROM ({_SCD2}) WHERE valid_from <= TIMESTAMP '2024-01-03 00:00:00' "
    "AND (valid_to IS NULL OR TIMESTAMP '2024-01-03 00:00:00' < valid_to)",
)
def _(spark, sf_dir):
    return history.scd2_as_of(staging.party_history(spark, sf_dir), "2024-01-03 00:00:00")


# -- versions --------------------------------------------------------------------------------------

_V1 = f"SELECT {_COLUMNS} FROM ({_UPSERT})"
_V2 = (
    f"SELECT {_COLUMNS}, NULL::VARCHAR AS brand FROM ({_UPSERT}) UNION ALL "
    "SELECT concat('P', p_partkey::VARCHAR), p_name, NULL, NULL, NULL, p_brand FROM part"
)


@register("version_read", _V1)
def _(spark, sf_dir):
    return staging.party_table(spark, sf_dir).read(version=1)


@register("version_at_time", TARGET_SQL)
def _(spark, sf_dir):
    return staging.party_table(spark, sf_dir).read(at="2024-01-03 00:00:00")


@register("version_appended", _V2)
def _(spark, sf_dir):
    return staging.party_table(spark, sf_dir).read(version=2)


@register("version_latest", _V2)
def _(spark, sf_dir):
    return staging.party_table(spark, sf_dir).read()


@register(
    "commit_history",
    f"WITH u AS ({_UPSERT}) SELECT 0::BIGINT AS version, TIMESTAMP '{T0}' AS timestamp, 'WRITE' AS operation, 'loader' AS user_name, "
    "(SELECT count(*) FROM customer) AS rows, NULL::BIGINT AS inserted, NULL::BIGINT AS updated "
    f"UNION ALL SELECT 1, TIMESTAMP '{T1}', 'MERGE', 'loader', (SELECT count(*) FROM u), "
    "(SELECT count(*) FROM u WHERE action = 'inserted'), (SELECT count(*) FROM u WHERE action = 'updated') "
    f"UNION ALL SELECT 2, TIMESTAMP '{T2}', 'WRITE', 'loader', (SELECT count(*) FROM part), NULL, NULL "
    f"UNION ALL SELECT 3, TIMESTAMP '{T3}', 'OPTIMIZE', 'loader', (SELECT count(*) FROM u) + (SELECT count(*) FROM part), NULL, NULL",
)
def _(spark, sf_dir):
    log = staging.party_table(spark, sf_dir).history()
    metrics = F.col("metrics")
    return log.select(
        "version",
        "timestamp",
        "operation",
        "user_name",
        metrics["numOutputRows"].alias("rows"),
        F.try_element_at(metrics, F.lit("inserted")).alias("inserted"),
        F.try_element_at(metrics, F.lit("updated")).alias("updated"),
    )


@register(
    "commit_history_last",
    f"SELECT 3::BIGINT AS version, 'OPTIMIZE' AS operation, (SELECT count(*) FROM ({_V2})) AS rows",
)
def _(spark, sf_dir):
    last = staging.party_table(spark, sf_dir).history(limit=1)
    return last.select("version", "operation", F.col("metrics")["numOutputRows"].alias("rows"))


@register(
    "expired_versions",
    f"SELECT 0::BIGINT AS version, TIMESTAMP '{T0}' AS timestamp, (SELECT count(*) FROM customer) AS rows",
)
def _(spark, sf_dir):
    expired = staging.party_table(spark, sf_dir).expired(as_of=T3)
    return expired.select("version", "timestamp", F.col("metrics")["numOutputRows"].alias("rows"))


@register("retain_versions", f"SELECT 1::BIGINT AS kept_version, {_COLUMNS} FROM ({_UPSERT})")
def _(spark, sf_dir):
    table = tables.VersionedTable(spark, fresh_path(spark, "retained"))
    table.save(inputs.party_target(spark, sf_dir), as_of=T0)
    table.merge(inputs.party_source(spark, sf_dir), keys=["party_id"], as_of=T1)
    table.compact(as_of=T2)
    oldest = table.retain(as_of=T3)
    return table.read(version=oldest).withColumn("kept_version", F.lit(oldest).cast("bigint"))


@register(
    "upsert_partitions",
    "SELECT coalesce(t.nation, s.nation) AS nation, coalesce(t.party_id, s.party_id) AS party_id, "
    + ", ".join(f"CASE WHEN s.party_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ("name", "segment", "balance"))
    + f" FROM ({TARGET_SQL}) t FULL JOIN (SELECT * FROM ({SOURCE_SQL}) WHERE nation < 10) s ON t.party_id = s.party_id AND t.nation = s.nation",
)
def _(spark, sf_dir):
    """A load for some nations: only their partitions are written again."""
    path = fresh_path(spark, "parties-by-nation")
    inputs.party_target(spark, sf_dir).write.partitionBy("nation").parquet(path)
    source = inputs.party_source(spark, sf_dir).where("nation < 10")
    tables.upsert_partitions(spark, path, source, ["nation", "party_id"], ["nation"])
    return spark.read.parquet(path)


@register("compact", "SELECT * FROM lineitem")
def _(spark, sf_dir):
    table = tables.VersionedTable(spark, fresh_path(spark, "lineitem"))
    table.save(inputs.table(spark, sf_dir, "lineitem"), as_of=T0)
    table.compact(as_of=T1)
    return table.read()


@register(
    "compact_files",
    "SELECT count(*) AS rows, 24::BIGINT AS files_before, true AS fewer_files, sum(l_orderkey)::BIGINT AS keys FROM lineitem",
)
def _(spark, sf_dir):
    """Many small files become fewer; the rows stay."""
    table = tables.VersionedTable(spark, fresh_path(spark, "scattered"))
    table.save(inputs.table(spark, sf_dir, "lineitem").repartition(24), as_of=T0)
    table.compact(as_of=T1)

    def files(version):
        rows = table.read(version=version).groupBy(F.input_file_name().alias("file"))
        per_file = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("k"))
        return per_file.select(F.lit(version).alias("version"), "n", "k")

    old, new = F.col("version") == 0, F.col("version") == 1
    return files(0).unionByName(files(1)).agg(
        F.sum(F.when(new, F.col("n"))).alias("rows"),
        F.count_if(old).alias("files_before"),
        (F.count_if(new) < F.count_if(old)).alias("fewer_files"),
        F.sum(F.when(new, F.col("k"))).alias("keys"),
    )


@register("cluster", "SELECT * FROM lineitem")
def _(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem")
    return tables.clustered(rows, ["l_shipdate", "l_partkey"])


@register("cluster_ranges", "SELECT true AS several_files, 0::BIGINT AS overlaps, count(*) AS rows FROM part")
def _(spark, sf_dir):
    """The text ranges of the stored files of a clustered table follow each other."""
    table = tables.VersionedTable(spark, fresh_path(spark, "clustered"))
    table.save(inputs.table(spark, sf_dir, "part").repartition(8), as_of=T0)
    table.cluster(["p_name"], files=8, as_of=T1)
    files = table.read().groupBy(F.input_file_name().alias("file")).agg(
        F.min("p_name").alias("low"), F.max("p_name").alias("high"), F.count(F.lit(1)).alias("n")
    )
    # one row for each file
    before = F.max("high").over(W.orderBy("low", "high").rowsBetween(W.unboundedPreceding, -1))
    ranges = files.withColumn("before", before)
    return ranges.agg(
        (F.count(F.lit(1)) > 1).alias("several_files"),
        F.count_if(F.col("low") < F.col("before")).alias("overlaps"),
        F.sum("n").alias("rows"),
    )


# -- rights of the data subject --------------------------------------------------------------------

# erasure is asked for by customers with a negative balance, on a day drawn from their key
_ERASURES = (
    "SELECT c_custkey, concat('PAC-', lpad(CAST(c_custkey AS VARCHAR(20)), 6, '0')) AS patient_id, "
    "{ts} AS requested_at FROM {customer} WHERE c_acctbal < 0"
)
_ERASURES_SQL = _ERASURES.format(
    ts="TIMESTAMP '2001-07-01 00:00:00' + to_days(CAST(c_custkey % 30 AS INT))", customer="customer"
)


def erasures(spark, sf_dir):
    day = F.make_dt_interval(days=(F.col("c_custkey") % 30).cast("int"))
    return inputs.table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(
        F.expr("concat('PAC-', lpad(CAST(c_custkey AS VARCHAR(20)), 6, '0'))").alias("patient_id"),
        (F.lit("2001-07-01 00:00:00").cast("timestamp") + day).alias("requested_at"),
    )


@register(
    "soft_delete",
    f"SELECT e.*, coalesce(e.patient_id IN (SELECT patient_id FROM ({_ERASURES_SQL})), false) AS is_deleted "
    f"FROM ({ENC_SQL}) e",
)
def _(spark, sf_dir):
    return privacy.soft_delete(inputs.encounters(spark, sf_dir), erasures(spark, sf_dir))


@register(
    "soft_delete_visible",
    f"SELECT * FROM ({ENC_SQL}) e WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({_ERASURES_SQL}) x WHERE x.patient_id = e.patient_id)",
)
def _(spark, sf_dir):
    return privacy.visible(privacy.soft_delete(inputs.encounters(spark, sf_dir), erasures(spark, sf_dir)))


@register(
    "purge",
    f"SELECT * FROM ({ENC_SQL}) e WHERE NOT EXISTS (SELECT 1 FROM ({_ERASURES_SQL}) x "
    f"WHERE x.patient_id = e.patient_id AND x.requested_at <= TIMESTAMP '{inputs.AS_OF}' - INTERVAL 168 HOUR)",
)
def _(spark, sf_dir):
    return privacy.purge(
        inputs.encounters(spark, sf_dir), erasures(spark, sf_dir), requested="requested_at", retention_hours=168, as_of=inputs.AS_OF
    )


@register(
    "revoke_consent",
    f"SELECT estado, count(*) AS encounters FROM ({ENC_SQL}) e WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({_ERASURES_SQL}) x WHERE x.patient_id = e.patient_id) GROUP BY estado",
)
def _(spark, sf_dir):
    rows = inputs.encounters(spark, sf_dir).select("estado", "patient_id")
    kept = privacy.without_revoked(rows, erasures(spark, sf_dir))
    return kept.groupBy("estado").agg(F.count(F.lit(1)).alias("encounters"))


_SUBJECT = "PAC-000007"


@register(
    "subject_lookup",
    f"SELECT encounter_id, blood_pressure, sha256(concat(patient_id, '{KEY}')) AS patient_id FROM ({ENC_SQL}) "
    f"WHERE patient_id = '{_SUBJECT}'",
)
def _(spark, sf_dir):
    stored = cleaning.mask_sensitive(
        inputs.encounters(spark, sf_dir).select("encounter_id", "patient_id", "blood_pressure"), KEY
    )
    return privacy.subject_rows(stored, _SUBJECT, KEY)


@register(
    "subjects_lookup",
    f"SELECT encounter_id, patient_id FROM ({ENC_SQL}) WHERE patient_id IN (SELECT patient_id FROM ({_ERASURES_SQL}))",
)
def _(spark, sf_dir):
    rows = inputs.encounters(spark, sf_dir).select("encounter_id", "patient_id")
    return privacy.subjects_rows(rows, erasures(spark, sf_dir))


def _register_export(fmt):
    @register(
        f"subject_export_{fmt}",
        f"SELECT * FROM ({ENC_SQL}) WHERE patient_id IN "
        f"(SELECT patient_id FROM ({_ERASURES_SQL}))",
    )
    def _(spark, sf_dir):
        rows = inputs.encounters(spark, sf_dir)
        wanted = privacy.subjects_rows(rows, erasures(spark, sf_dir)).select(*[ref(c) for c in rows.columns])
        path = privacy.export_subject(wanted, fresh_path(spark, "export"), fmt)
        return readers.read_file(spark, path, fmt, schema=rows.schema)


for _fmt in ("csv", "json"):
    _register_export(_fmt)
