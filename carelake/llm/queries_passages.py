"""Registered query of repeated passages. SQL would need a row for each byte: tests compare brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import suffix_dedup
from carelake.llm.common import table

#: bytes of a string that counts as repeated
LENGTH = 400


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), LENGTH).drop("spans")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
