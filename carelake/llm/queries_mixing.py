"""Registered query of source mixing. Its hashes are not in SQL: tests check its laws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import mixing
from carelake.llm.common import table

#: no source gives more than so many times what it holds
MOST = 3.0


def schedule(place: int, name: str | None) -> mixing.Knots:
    """Weights 1, 2, 3, repeating; every other source fades out while the others fade in."""
    weight = 1.0 + place % 3
    lean = 0.5 if place % 2 else -0.5
    return [(0.0, weight * (1 - lean)), (1.0, weight * (1 + lean))]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.curriculum(table(spark, sf_dir, "documents"), schedule, MOST)
    rows = plan.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
        F.col("_source").alias("source"),
        F.get("_positions", F.lit(0)).alias("first_position"),
    )
    return mixing.by_position(rows, "first_position", "doc_id")


QUERIES = {"op1_mix": op1_mix}
