"""Registered queries of the operators that judge documents by models of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import quality, toxicity
from carelake.llm.common import table


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), ["doc_id"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op4_toxicity": op4_toxicity, "op6_quality": op6_quality}
