"""The table of registered queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carelake.columns import ref
from carelake.functions import records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: comparable(query(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = sql
        return query

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types every engine shares: zone-less timestamps, dates as text, doubles for decimals."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            casts[field.name] = ref(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            casts[field.name] = ref(field.name).cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            casts[field.name] = ref(field.name).cast("double")
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of a distributed sum does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: records.nearest(ref(c), digits) for c in doubles}) if doubles else df
