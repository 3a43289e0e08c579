"""Public reference feeds: landed JSON payloads to normalised tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import fixed_values as fx
from carelake import schemas

# Payload field -> column of the summary table, in column order.
SUMMARY_COLUMNS = {
    "country": "pais",
    "cases": "casos_total",
    "deaths": "mortes_total",
    "recovered": "recuperados",
    "active": "ativos",
    "casesPerOneMillion": "casos_por_milhao",
    "deathsPerOneMillion": "mortes_por_milhao",
    "tests": "testes_total",
    "population": "populacao",
}
SUMMARY_COUNTRY = "Brazil"


def states(payload: DataFrame) -> DataFrame:
    """State records with the region name lifted out of its object."""
    return payload.select(
        F.col("id").alias("estado_id"),
        "sigla",
        F.col("nome").alias("nome_estado"),
        F.col("regiao.nome").alias("regiao"),
    )


def summary(payload: DataFrame) -> DataFrame:
    """Country totals; missing numbers are 0, the update instant (epoch ms) becomes text."""
    defaults = {"country": F.lit(SUMMARY_COUNTRY)}
    chosen = [
        F.coalesce(F.col(field), defaults.get(field, F.lit(0))).alias(name)
        for field, name in SUMMARY_COLUMNS.items()
    ]
    updated = F.timestamp_millis(F.coalesce(F.col("updated"), F.lit(0)))
    return payload.select(*chosen, F.date_format(updated, fx.TEXT_TIMESTAMP_FORMAT).alias("data_atualizacao"))


def timeline(payload: DataFrame, *keep: str) -> DataFrame:
    """One row per date of the case map, with deaths and recoveries of that date or 0."""

    def on_day(series: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(f"timeline.{series}"), F.col("data")), F.lit(0))

    days = payload.select(*keep, "timeline", F.explode("timeline.cases").alias("data", "casos_acumulados"))
    return days.select(
        *keep,
        "data",
        "casos_acumulados",
        on_day("deaths").alias("mortes_acumuladas"),
        on_day("recovered").alias("recuperados_acumulados"),
    )


# name -> (payload schema, shaping)
FEEDS = {
    "estados_ibge": (schemas.STATE_PAYLOAD, states),
    "covid_brasil": (schemas.SUMMARY_PAYLOAD, summary),
    "covid_historico": (schemas.TIMELINE_PAYLOAD, timeline),
}


@dataclass(frozen=True)
class FeedLoad:
    """The readable records of a feed, how many files were not readable, and why it has none at all."""

    rows: DataFrame
    broken: int = 0
    failure: str | None = None


def read_feed(spark: SparkSession, name: str, path: str) -> FeedLoad:
    """One landed feed, normalised. A payload file is one response, an object or an array of them;
    files that do not parse are counted and left out. A payload that is missing or cannot be read at
    all gives the empty table and the failure."""
    schema, shape = FEEDS[name]
    try:
        bodies = spark.read.text(path, wholetext=True)
        parsed = bodies.select(F.from_json("value", T.ArrayType(schema)).alias("records"))
        bad = parsed.where(F.col("records").isNull()).count()
    except PySparkException as failure:
        nothing = spark.createDataFrame([], schema)
        return FeedLoad(shape(nothing), 0, f"{type(failure).__name__}: {failure}".splitlines()[0])
    return FeedLoad(shape(parsed.select(F.inline("records"))), bad)


def load_feed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The readable records of one landed feed."""
    return read_feed(spark, name, path).rows


def load_feeds(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, FeedLoad]:
    """Every known feed; those without a path are empty."""
    return {
        name: read_feed(spark, name, paths[name])
        if name in paths
        else FeedLoad(shape(spark.createDataFrame([], schema)), 0, "no path")
        for name, (schema, shape) in FEEDS.items()
    }


def land_feeds(feeds: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """Write each feed that has rows as JSON below its own name; returns the paths written."""
    written = {}
    for name, rows in feeds.items():
        if rows.isEmpty():
            continue
        path = f"{directory.rstrip('/')}/api_{name}.json"
        rows.write.mode("overwrite").json(path)
        written[name] = path
    return written
