"""Types that grow, layout on several columns, compaction of what needs it, merges on ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.functions import masking
from carelake.operators import history
from carelake.plans import inputs
from carelake.plans.inputs import ENC_SQL, KEY
from carelake.plans.registry import register
from carelake.plans.staging import T0, T1, T2
from carelake.session import fresh_path
from carelake.sources import tables

# -- types that grow -------------------------------------------------------------------------------

# whole numbers and days first, then long keys, fractions and instants
_NARROW = "CAST(l_orderkey AS INT) AS k, CAST(l_quantity AS INT) AS q, CAST(l_shipdate AS DATE) AS d, l_comment AS c"
_WIDE = "l_orderkey + 3000000000 AS k, CAST(l_quantity AS DOUBLE) / 4 AS q, CAST(l_shipdate AS TIMESTAMP) AS d, l_comment AS c"


def _grown_table(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem").withColumn("l_comment", F.col("l_returnflag"))
    table = tables.VersionedTable(spark, fresh_path(spark, "grown"))
    exprs = [[e.strip() for e in part.split(", ")] for part in (_NARROW, _WIDE)]
    table.save(rows.where("l_linenumber % 2 = 0").selectExpr(*exprs[0]), as_of=T0)
    table.save(rows.where("l_linenumber % 2 = 1").selectExpr(*exprs[1]), mode="append", as_of=T1)
    table.save(rows.where("l_linenumber % 2 = 0").selectExpr(*exprs[0]), mode="append", as_of=T2)
    return table


def _grown_sql(part: str, odd: int) -> str:
    return f"SELECT {part.replace('l_comment', 'l_returnflag')} FROM lineitem WHERE l_linenumber % 2 = {odd}"


@register(
    "append_wider_types",
    f"SELECT CAST(k AS BIGINT) AS k, CAST(q AS DOUBLE) AS q, CAST(d AS TIMESTAMP) AS d, c FROM ({_grown_sql(_NARROW, 0)} "
    f"UNION ALL {_grown_sql(_WIDE, 1)} UNION ALL {_grown_sql(_NARROW, 0)})",
)
def _(spark, sf_dir):
    """Longs, doubles and timestamps appended to a table of ints and dates, then ints once more."""
    return _grown_table(spark, sf_dir).read()


@register("read_before_types_grew", _grown_sql(_NARROW, 0).replace("CAST(l_shipdate AS DATE)", "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"))
def _(spark, sf_dir):
    """The first version keeps the types that it was written with."""
    return _grown_table(spark, sf_dir).read(version=0)


# -- layout on two columns -------------------------------------------------------------------------

_FILES = 64
_FILTERS = {"part": ("l_partkey", "l_partkey <= 20"), "supplier": ("l_quantity", "l_quantity BETWEEN 20 AND 22")}


@register(
    "zorder_skips_files",
    " UNION ALL ".join(
        f"SELECT '{name}' AS filter, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, true AS under_half FROM lineitem WHERE {term}"
        for name, (_, term) in _FILTERS.items()
    ),
)
def _(spark, sf_dir):
    """Filters on either column of a table on a curve give the same rows, and the files whose range
    meets the filter are under half of all."""
    table = tables.VersionedTable(spark, fresh_path(spark, "curve"))
    table.save(inputs.table(spark, sf_dir, "lineitem"), as_of=T0)
    table.zorder(["l_partkey", "l_quantity"], files=_FILES, as_of=T1)
    rows = table.read().withColumn("file", F.input_file_name())
    met = []
    for name, (_, term) in _FILTERS.items():
        hit = F.expr(term)
        files = rows.groupBy("file").agg(F.count_if(hit).alias("n"), F.sum(F.when(hit, F.col("l_orderkey"))).alias("k"))
        met.append(
            files.agg(
                F.lit(name).alias("filter"),
                F.sum("n").alias("rows"),
                F.sum("k").alias("keys"),
                (F.count_if(F.col("n") > 0) * 2 < F.count(F.lit(1))).alias("under_half"),
            )
        )
    return met[0].unionByName(met[1])


# -- compaction --------------------------------------------------------------------------------------


@register(
    "compact_partitions",
    "SELECT l_returnflag, count(*) AS rows, l_returnflag = 'R' AS same_files, l_returnflag <> 'R' AS fewer_files FROM lineitem GROUP BY ALL",
)
def _(spark, sf_dir):
    """One partition is in one file, the others in six each: only those are written again."""
    path, listed = fresh_path(spark, "flags"), fresh_path(spark, "listed")
    rows = inputs.table(spark, sf_dir, "lineitem")
    rows.where("l_returnflag = 'R'").coalesce(1).write.partitionBy("l_returnflag").parquet(path)
    rows.where("l_returnflag <> 'R'").repartition(6).write.mode("append").partitionBy("l_returnflag").parquet(path)

    def files():
        return spark.read.parquet(path).groupBy("l_returnflag", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))

    files().write.parquet(listed)
    tables.compact_partitions(spark, path, ["l_returnflag"])
    before = spark.read.parquet(listed).select("l_returnflag", "file", F.lit(1).alias("was"))
    both = files().join(before, ["l_returnflag", "file"], "full")
    return both.groupBy("l_returnflag").agg(
        F.sum("n").alias("rows"),
        F.every(F.col("n").isNotNull() & F.col("was").isNotNull()).alias("same_files"),
        (F.count("n") < F.count("was")).alias("fewer_files"),
    )


# -- merges on ranges --------------------------------------------------------------------------------

_RANGES = "o_orderkey AS k, o_orderkey * 20 AS low, o_orderkey * 20 + o_orderkey % 10 AS high, CAST(NULL AS BIGINT) AS at, o_totalprice AS price"
_POINTS = "o_orderkey * 20 + (o_orderkey * 7) % 20 AS at, o_totalprice + 1 AS price"


@register(
    "upsert_in_ranges",
    f"WITH t AS (SELECT {_RANGES} FROM orders), s AS (SELECT {_POINTS} FROM orders) "
    "SELECT k, low, high, s.at, coalesce(s.price, t.price) AS price, CASE WHEN s.at IS NULL THEN 'kept' ELSE 'updated' END AS action "
    "FROM t LEFT JOIN s ON s.at BETWEEN t.low AND t.high UNION ALL "
    "SELECT NULL, NULL, NULL, s.at, s.price, 'inserted' FROM s LEFT JOIN t ON s.at BETWEEN t.low AND t.high WHERE t.k IS NULL",
)
def _(spark, sf_dir):
    """Rows of the source that fall into a range of the target change it, the others are new."""
    orders = inputs.table(spark, sf_dir, "orders")
    target, source = orders.selectExpr(*_RANGES.split(", ")), orders.selectExpr(*_POINTS.split(", "))
    return history.upsert_where(target, source, "source.at BETWEEN target.low AND target.high", ["k"], action_column="action")


# -- keyed digests -----------------------------------------------------------------------------------


def _pad(byte: int) -> str:
    return bytes(b ^ byte for b in KEY.encode().ljust(masking.HMAC_BLOCK, b"\0")).hex()


@register(
    "hmac_hash",
    f"SELECT encounter_id, sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(cpf)))) AS cpf FROM ({ENC_SQL})",
)
def _(spark, sf_dir):
    return inputs.encounters(spark, sf_dir).select("encounter_id", masking.hmac_hash(F.col("cpf"), KEY).alias("cpf"))
