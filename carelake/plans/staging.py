"""Tables the registered queries write below the shared folder before reading them back.

Each is built once per session and data set, from the whole given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.columns import refs
from carelake.operators import history
from carelake.plans import flows, inputs
from carelake.session import fresh_path
from carelake.sources import writers
from carelake.sources.tables import VersionedTable
from carelake.sources.writers import LakeLayout
from carelake.streaming import envelopes

# commit times of the staged tables
T0, T1, T2, T3 = ("2024-01-01 00:00:00", "2024-01-05 00:00:00", "2024-01-08 00:00:00", "2024-01-12 00:00:00")


def once(build: Callable) -> Callable:
    """Remember what was built for a session and data set, until `forget` is called."""

    @wraps(build)
    def staged(spark: SparkSession, sf_dir: str):
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _BUILT:
            _BUILT[key] = build(spark, sf_dir)
        return _BUILT[key]

    return staged


_BUILT: dict[tuple[str, str, str], object] = {}


def forget() -> None:
    """Build everything anew from now on."""
    _BUILT.clear()


@once
def party_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Four versions: customers, the load merged in, parts appended with a new column, compacted."""
    table = VersionedTable(spark, fresh_path(spark, "parties"), user="loader")
    table.save(inputs.party_target(spark, sf_dir), as_of=T0)
    table.merge(inputs.party_source(spark, sf_dir), keys=["party_id"], as_of=T1)
    parts = inputs.table(spark, sf_dir, "part").selectExpr(
        "concat('P', CAST(p_partkey AS VARCHAR(20))) AS party_id", "p_name AS name", "p_brand AS brand"
    )
    table.save(parts, mode="append", as_of=T2)
    table.compact(as_of=T3)
    return table


@once
def party_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two history loads: customers, then the later load."""
    first = history.scd2_start(inputs.party_target(spark, sf_dir), T0)
    return history.scd2_apply(first, inputs.party_source(spark, sf_dir), ["party_id"], T1)


@once
def vital_messages(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one message envelope per event."""
    path = fresh_path(spark, "messages")
    envelopes.wrap(inputs.vitals(spark, sf_dir), "timestamp").write.parquet(path)
    return path


def state_payload(spark: SparkSession, sf_dir: str) -> str:
    """The response of a state service: one JSON array of all nations."""
    states = inputs.state_reference(spark, sf_dir).selectExpr(
        "estado_id AS id", "sigla", "nome_estado AS nome", "named_struct('nome', regiao) AS regiao"
    )
    path = fresh_path(spark, "state-payload")
    states.select(F.to_json(F.collect_list(F.struct(*states.columns)))).write.text(path)
    return path


@once
def medallion(spark: SparkSession, sf_dir: str) -> flows.FlowSettings:
    """A lake filled by the whole flow from a CSV and a JSON landing of all encounters."""
    root = fresh_path(spark, "lake")
    settings = flows.FlowSettings(LakeLayout(root), inputs.KEY, run_id="check", as_of=inputs.AS_OF)
    names = schemas.ENCOUNTER.fieldNames()
    text = F.date_format(F.expr(inputs.LANDED_AT), "yyyy-MM-dd HH:mm:ss")
    records = inputs.encounters(spark, sf_dir).withColumn("timestamp", text).select(*refs(names))
    landing = writers.write_pair(records, f"{root}/landing/batch1.csv", f"{root}/landing/batch2.jsonl", f"{root}/scratch")
    flows.run(spark, settings, *landing, schema=schemas.ENCOUNTER, feed_paths={"estados_ibge": state_payload(spark, sf_dir)})
    return settings
