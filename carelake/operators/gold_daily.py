"""Gold kept as sums and counts by day, so that a landed day costs a scan of that day.

Every measure of Gold is a count or a mean. Both follow from sums and counts, which add up over days:
the partials of a day are replaced when its rows are, and Gold is folded from the partials, a few rows
for each day and group however many encounters they stand for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import ref
from carelake.sources import writers
from carelake.sources.writers import LakeLayout

DAY = "date"
PARTIALS = "partials"


@dataclass(frozen=True)
class Rollup:
    """A Gold table: its group, the name of its row count, means of Silver columns, and counts of
    rows whose column has a value."""

    by: str
    total: str
    means: Mapping[str, str]
    counts: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def applies_to(self, silver: DataFrame) -> bool:
        needed = {self.by, *self.means.values(), *(column for column, _ in self.counts.values())}
        return needed <= set(silver.columns)


ROLLUPS: dict[str, Rollup] = {
    "por_diagnostico": Rollup(
        "diagnostico",
        "total_pacientes",
        {
            "media_freq_cardiaca": "heart_rate",
            "media_sistolica": "sistolica",
            "media_diastolica": "diastolica",
            "media_temperatura": "temperatura",
        },
    ),
    "por_estado": Rollup(
        "estado",
        "total_pacientes",
        {"media_freq_cardiaca": "heart_rate"},
        {"pacientes_pressao_alta": ("categoria_pressao", fx.PRESSURE_HIGH_NAME)},
    ),
    "por_pressao": Rollup("categoria_pressao", "total", {"media_sistolica": "sistolica", "media_diastolica": "diastolica"}),
}


def partials(silver: DataFrame, rollup: Rollup, day: str = DAY) -> DataFrame:
    """One row per day and group: the row count, and sum and number of the values of every mean."""
    sums = [F.sum(ref(c)).alias(f"{name}_sum") for name, c in rollup.means.items()]
    numbers = [F.count(ref(c)).alias(f"{name}_n") for name, c in rollup.means.items()]
    counts = [F.count_if(ref(c) == value).alias(name) for name, (c, value) in rollup.counts.items()]
    total = F.count(F.lit(1)).alias(rollup.total)
    return silver.groupBy(ref(day).alias(DAY), ref(rollup.by)).agg(total, *sums, *numbers, *counts)


def fold(by_day: DataFrame, rollup: Rollup) -> DataFrame:
    """Gold from partials. A mean without values is null; a group without rows is none."""
    means = [F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in rollup.means]
    counts = [F.sum(name).alias(name) for name in rollup.counts]
    # rows of 0 stand for days that have lost all theirs
    held = by_day.where(F.col(rollup.total) > 0)
    return held.groupBy(ref(rollup.by)).agg(F.sum(rollup.total).alias(rollup.total), *means, *counts)


def on_days(days: Sequence[date | None], day: str = DAY) -> Column:
    """Whether a row is of one of the days; None is the day of rows without one."""
    named = ref(day).isin([d for d in days if d is not None])
    return named | ref(day).isNull() if None in days else named


def store_partials(
    spark: SparkSession, layout: LakeLayout, table: str, days: Sequence[date | None] | None = None
) -> list[str]:
    """Partials of the stored Silver table, of all days or, replacing what is there, of `days`. Gives
    the names of the Gold tables that apply. Without partials of all days, `days` is refused by Spark,
    which finds no table."""
    silver = writers.read_layer(spark, layout, "silver", table)
    names = [name for name, rollup in ROLLUPS.items() if rollup.applies_to(silver)]
    for name in names:
        rollup, target = ROLLUPS[name], f"{PARTIALS}/{name}"
        if days is None:
            writers.write_layer(partials(silver, rollup), layout, "gold", target, [DAY], replace_all=True)
            continue
        writers.read_layer(spark, layout, "gold", target)
        nothing = spark.createDataFrame([(d, 0) for d in days], f"{DAY} date, {rollup.total} bigint")
        changed = partials(silver.where(on_days(days)), rollup).unionByName(nothing, allowMissingColumns=True)
        writers.write_layer(changed, layout, "gold", target, [DAY])
    return names


def read_gold(spark: SparkSession, layout: LakeLayout, name: str) -> DataFrame:
    """A Gold table, folded from its stored partials."""
    return fold(writers.read_layer(spark, layout, "gold", f"{PARTIALS}/{name}"), ROLLUPS[name])
