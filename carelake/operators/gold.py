"""Gold aggregates and the reporting queries over them.

Each aggregate reads four to six columns of Silver, combines map-side and shuffles one row per
group and task, so a diagnosis that holds a third of all encounters costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import ref
from carelake.functions import records


def _rollup(df: DataFrame, by: str, measures: Mapping[str, Column], total: str) -> DataFrame:
    counted = F.count(F.lit(1)).alias(total)
    return df.groupBy(ref(by)).agg(counted, *[m.alias(name) for name, m in measures.items()])


def by_diagnosis(silver: DataFrame) -> DataFrame:
    """Encounters and mean vitals per diagnosis; a missing diagnosis is a group of its own."""
    return _rollup(
        silver,
        "diagnostico",
        {
            "media_freq_cardiaca": F.mean("heart_rate"),
            "media_sistolica": F.mean("sistolica"),
            "media_diastolica": F.mean("diastolica"),
            "media_temperatura": F.mean("temperatura"),
        },
        total="total_pacientes",
    )


def by_state(silver: DataFrame) -> DataFrame | None:
    """Encounters, mean heart rate and high-pressure count per state; None without a state column."""
    if "estado" not in silver.columns:
        return None
    return _rollup(
        silver,
        "estado",
        {
            "media_freq_cardiaca": F.mean("heart_rate"),
            "pacientes_pressao_alta": F.count_if(F.col("categoria_pressao") == fx.PRESSURE_HIGH_NAME),
        },
        total="total_pacientes",
    )


def by_pressure(silver: DataFrame) -> DataFrame:
    return _rollup(
        silver,
        "categoria_pressao",
        {"media_sistolica": F.mean("sistolica"), "media_diastolica": F.mean("diastolica")},
        total="total",
    )


def ranked(gold: DataFrame, measure: str, key: str, top: int | None = None) -> DataFrame:
    """Largest measure first, key as tie-break; with ``top`` Spark keeps a bounded heap per task."""
    ordered = gold.orderBy(ref(measure).desc(), ref(key).asc_nulls_first())
    return ordered if top is None else ordered.limit(top)


# -- reporting -----------------------------------------------------------------------------------


def total_encounters(gold: DataFrame) -> DataFrame:
    return gold.agg(F.sum("total_pacientes").alias("total"))


def group_number(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count(F.lit(1)).alias("diagnosticos"))


def chart(gold: DataFrame) -> DataFrame:
    """Named diagnoses only, largest first."""
    named = gold.where(F.col("diagnostico").isNotNull()).select("diagnostico", "total_pacientes")
    return ranked(named, "total_pacientes", "diagnostico")


def detail(gold: DataFrame) -> DataFrame:
    """Means rounded half-up to one decimal for display."""
    means = [c for c in gold.columns if c.startswith("media_")]
    shown = gold.select(
        "diagnostico", "total_pacientes", *[records.display_round(ref(c)).alias(c) for c in means]
    )
    return ranked(shown, "total_pacientes", "diagnostico")


def states_per_region(states: DataFrame) -> DataFrame:
    counted = states.groupBy("regiao").agg(F.count(F.lit(1)).alias("total_estados"))
    return ranked(counted, "total_estados", "regiao")


def fatality(summary: DataFrame) -> DataFrame:
    return summary.select(
        "pais",
        "casos_total",
        "mortes_total",
        "recuperados",
        records.ratio_pct(F.col("mortes_total"), F.col("casos_total")).alias("taxa_mortalidade"),
    )


def timeline(history: DataFrame) -> DataFrame:
    """Cumulative counts in calendar order; the date text is ``M/d/yy``, which does not sort itself."""
    day = F.try_to_timestamp(F.col("data"), F.lit("M/d/yy")).cast("date")
    return history.select("data", "casos_acumulados", "mortes_acumuladas").orderBy(day, "data")


def with_region(encounters: DataFrame, states: DataFrame) -> DataFrame:
    """Encounters with the name and region of their state; unknown states stay, with nulls.

    No join hint: the state table is broadcast when its measured size is below the session's
    threshold and shuffled otherwise, where AQE splits a state that dominates.
    """
    named = states.select(F.col("sigla").alias("estado"), "nome_estado", "regiao")
    return encounters.join(named, "estado", "left")
