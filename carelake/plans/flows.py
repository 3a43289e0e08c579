"""Layered flows.

Steps hand over through stored tables, not lineage: Bronze is written once from the sources,
Silver reads Bronze, Gold reads Silver. An executor or driver lost in one step repeats that step
only, and quality numbers are taken from the stored Parquet, not by re-reading source text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake.columns import instant
from carelake.operators import cleaning, gold, gold_daily, governance, quality
from carelake.operators.runlog import StageTimer
from carelake.sources import feeds, readers, writers
from carelake.sources.writers import LakeLayout, Written
from carelake.streaming import sinks

TABLE = "healthcare"
DATA_LAYERS = ("bronze", "silver", "gold")
GOLD_TABLES: dict[str, Callable[[DataFrame], DataFrame | None]] = {
    "por_diagnostico": gold.by_diagnosis,
    "por_estado": gold.by_state,
    "por_pressao": gold.by_pressure,
}


@dataclass(frozen=True)
class FlowSettings:
    layout: LakeLayout
    masking_key: str
    run_id: str
    user: str = "admin"
    as_of: str | None = None


def ingest(
    spark: SparkSession,
    settings: FlowSettings,
    csv_path: str,
    json_path: str,
    schema: StructType | str | None = None,
) -> Written:
    """CSV and JSON records into Bronze, one date partition per event day, with a quality report."""
    _guard(spark, settings, "read", "bronze")
    parts = [readers.read_csv(spark, csv_path, schema), readers.read_json(spark, json_path, schema)]
    whole = cleaning.stack(*[cleaning.with_event_instant(p) for p in parts])
    written = writers.land_by_date(whole, settings.layout, "bronze", TABLE)
    _report(spark, settings, "bronze")
    return written


def build_silver(spark: SparkSession, settings: FlowSettings, streamed_path: str | None = None) -> Written:
    """Bronze, plus streamed rows if there are any, into cleaned, enriched, masked Silver."""
    _guard(spark, settings, "write", "silver")
    rows = writers.read_layer(spark, settings.layout, "bronze", TABLE)
    if streamed_path is not None:
        rows = cleaning.with_event_instant(sinks.with_stream(spark, rows, streamed_path))
    written = _land_silver(rows, settings)
    report = _report(spark, settings, "silver")
    alerts = quality.report_alerts(report).withColumn("run_id", F.lit(settings.run_id))
    writers.write_layer(alerts, settings.layout, "ops", "alerts", mode="append")
    return written


def land_feeds(spark: SparkSession, settings: FlowSettings, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Reference feeds into Bronze, those with rows; what could not be read is noted in ``ops``."""
    _guard(spark, settings, "write", "bronze")
    loads = feeds.load_feeds(spark, paths)
    noted = [(settings.run_id, name, load.broken, load.failure) for name, load in loads.items()]
    schema = "run_id string, feed string, broken_records bigint, failure string"
    writers.write_layer(spark.createDataFrame(noted, schema), settings.layout, "ops", "feeds", mode="append")
    landed = feeds.land_feeds({n: load.rows for n, load in loads.items()}, settings.layout.path("bronze", "feeds"))
    return {name: readers.read_json(spark, path, loads[name].rows.schema) for name, path in landed.items()}


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """The Gold aggregates that apply to the columns of this Silver table."""
    built = {name: aggregate(silver) for name, aggregate in GOLD_TABLES.items()}
    return {name: frame for name, frame in built.items() if frame is not None}


def store_gold(spark: SparkSession, settings: FlowSettings) -> dict[str, Written]:
    """Gold from stored Silver; every aggregate scans only the columns it needs."""
    silver = writers.read_layer(spark, settings.layout, "silver", TABLE)
    return {
        name: writers.write_layer(frame, settings.layout, "gold", name)
        for name, frame in build_gold(silver).items()
    }


def store_gold_by_day(spark: SparkSession, settings: FlowSettings) -> dict[str, Written]:
    """Gold by way of partial sums of every day, which `refresh_days` keeps up."""
    names = gold_daily.store_partials(spark, settings.layout, TABLE)
    return _store_folded(spark, settings, names)


def refresh_days(spark: SparkSession, settings: FlowSettings, days: Sequence[date]) -> dict[str, Written]:
    """Silver and Gold after `days` were landed again in Bronze. Only these days of Bronze and Silver
    are read; Gold is folded from the stored sums of all days.

    Copies of a row have its time, so deduplicating a day by itself gives the same rows. A day that
    cleaning leaves no rows of keeps those that Silver had. Needs `store_gold_by_day` once before."""
    _guard(spark, settings, "write", "silver")
    bronze = writers.read_layer(spark, settings.layout, "bronze", TABLE).where(gold_daily.on_days(days))
    _land_silver(bronze, settings)
    names = gold_daily.store_partials(spark, settings.layout, TABLE, days)
    return _store_folded(spark, settings, names)


def publish(frames: Mapping[str, DataFrame], connection: Mapping[str, str]) -> dict[str, str | None]:
    """Append frames to serving tables; a table that fails is reported, not fatal."""
    outcome: dict[str, str | None] = {}
    for table, frame in frames.items():
        try:
            writers.append_table(frame, table, connection)
            outcome[table] = None
        except Exception as failure:
            outcome[table] = f"{type(failure).__name__}: {failure}"
    return outcome


def run(
    spark: SparkSession,
    settings: FlowSettings,
    csv_path: str,
    json_path: str,
    schema: StructType | str | None = None,
    streamed_path: str | None = None,
    feed_paths: Mapping[str, str] | None = None,
    connection: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """All steps in order. Returns the stored Gold tables; run log, audit, quality reports, alerts
    and the outcome of publishing are appended to ``ops``."""
    timer = StageTimer(settings.run_id)
    try:
        served: dict[str, DataFrame] = {}
        if feed_paths is not None:
            with timer.stage("feeds") as facts:
                landed = land_feeds(spark, settings, feed_paths)
                facts["records"] = sum(frame.count() for frame in landed.values())
                served |= {f"api_{name}": frame for name, frame in landed.items()}
        with timer.stage("ingest") as facts:
            facts["records"] = ingest(spark, settings, csv_path, json_path, schema).rows
        with timer.stage("silver") as facts:
            facts["records"] = build_silver(spark, settings, streamed_path).rows
        with timer.stage("gold") as facts:
            written = store_gold(spark, settings)
            facts["records"] = sum(w.rows for w in written.values())
        stored = {name: writers.read_layer(spark, settings.layout, "gold", name) for name in written}
        sizes = writers.layer_bytes(spark, {layer: settings.layout.path(layer) for layer in DATA_LAYERS})
        writers.write_layer(sizes, settings.layout, "ops", "storage")
        if connection is not None:
            with timer.stage("publish") as facts:
                served |= {f"gold_{name.removeprefix('por_')}": frame for name, frame in stored.items()}
                outcome = publish(served, connection)
                noted = [(settings.run_id, name, failure) for name, failure in outcome.items()]
                rows = spark.createDataFrame(noted, "run_id string, target string, failure string")
                writers.write_layer(rows, settings.layout, "ops", "published", mode="append")
                if any(outcome.values()):
                    facts["error_type"] = "PublishFailure"
        return stored
    finally:
        timer.append(spark, settings.layout.path("ops", "runs"))


def _land_silver(bronze: DataFrame, settings: FlowSettings) -> Written:
    """Bronze rows deduplicated and laid out by day, then enriched and masked as they are written:
    masks and derived columns take more room than what they are made of."""
    rows = cleaning.clean(bronze.drop("date"), settings.as_of)

    def refine(cleaned: DataFrame) -> DataFrame:
        masked = cleaned.transform(cleaning.refine, settings.masking_key)
        return masked.transform(cleaning.add_record_metrics, settings.as_of)

    return writers.land_by_date(rows, settings.layout, "silver", TABLE, refine=refine)


def _store_folded(spark: SparkSession, settings: FlowSettings, names: Sequence[str]) -> dict[str, Written]:
    return {
        name: writers.write_layer(gold_daily.read_gold(spark, settings.layout, name), settings.layout, "gold", name)
        for name in names
    }


def _guard(spark: SparkSession, settings: FlowSettings, action: str, resource: str) -> None:
    """Leave an audit row for the step, then let it go on only if the user may take it."""
    request = spark.range(1).select(
        F.lit(settings.user).alias("user_id"), F.lit(action).alias("action"), F.lit(resource).alias("resource")
    )
    stamped = request.withColumn("timestamp", instant(settings.as_of))
    audit = governance.audit_rows(stamped, governance.user_table(spark), governance.role_table(spark))
    governance.append_audit(audit, settings.layout.path("ops", "audit"))
    governance.demand(settings.user, action)


def _report(spark: SparkSession, settings: FlowSettings, layer: str) -> DataFrame:
    """The quality report of a stored layer, appended to ``ops`` and returned as it was stored."""
    stored = writers.read_layer(spark, settings.layout, layer, TABLE)
    report = quality.quality_report(stored, layer).withColumn("run_id", F.lit(settings.run_id))
    writers.write_layer(report, settings.layout, "ops", f"quality/{layer}", mode="append")
    reports = writers.read_layer(spark, settings.layout, "ops", f"quality/{layer}")
    return reports.where(F.col("run_id") == settings.run_id)
