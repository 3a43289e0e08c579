"""Gold kept up day by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from carelake.operators import cleaning, gold_daily
from carelake.plans import flows, inputs
from carelake.plans.batch_queries import _DIAGNOSIS_SQL, _PRESSURE_SQL, _ROUNDED, _STATE_SQL, _round_sql
from carelake.plans.inputs import SILVER_SQL
from carelake.plans.registry import register, rounded
from carelake.plans.staging import once
from carelake.session import fresh_path
from carelake.sources import writers
from carelake.sources.writers import LakeLayout

# the day that is landed again, every heart rate of it higher and its high pressures gone
_AGAIN = date(2001, 7, 28)
_OF_DAY = "encounter_id % 28 = 27"
_CORRECTED_SQL = (
    f"SELECT * REPLACE (CASE WHEN {_OF_DAY} THEN heart_rate + 10 ELSE heart_rate END AS heart_rate) "
    f"FROM ({SILVER_SQL}) WHERE NOT ({_OF_DAY} AND categoria_pressao = 'alta')"
)


@once
def refreshed_lake(spark, sf_dir):
    """Silver of all encounters with sums by day, after one day was landed again."""
    layout = LakeLayout(fresh_path(spark, "daily"))
    rows = cleaning.clean(inputs.encounters(spark, sf_dir), inputs.AS_OF).drop("processing_time")
    placed = rows.withColumn("timestamp", F.expr(inputs.LANDED_AT))
    writers.land_by_date(placed, layout, "silver", flows.TABLE, refine=cleaning.refine)
    gold_daily.store_partials(spark, layout, flows.TABLE)
    landed = writers.read_layer(spark, layout, "silver", flows.TABLE).where(gold_daily.on_days([_AGAIN]))
    better = landed.where("categoria_pressao <> 'alta'").withColumn("heart_rate", F.col("heart_rate") + 10)
    path = fresh_path(spark, "day")
    better.write.parquet(path)
    writers.land_by_date(spark.read.schema(better.schema).parquet(path), layout, "silver", flows.TABLE)
    gold_daily.store_partials(spark, layout, flows.TABLE, [_AGAIN])
    return layout


def _register(name: str, table: str, sql: str) -> None:
    @register(name, sql.replace(SILVER_SQL, _CORRECTED_SQL))
    def _(spark, sf_dir):
        return rounded(gold_daily.read_gold(spark, refreshed_lake(spark, sf_dir), table))


_register("gold_changed_day", "por_diagnostico", _round_sql(_DIAGNOSIS_SQL, _ROUNDED))
_register("gold_changed_day_states", "por_estado", _STATE_SQL)
_register("gold_changed_day_pressure", "por_pressao", _PRESSURE_SQL)
