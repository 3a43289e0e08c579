"""Batch readers."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("csv", "json", "parquet")


def read_file(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", schema: StructType | str | None = None, **options
) -> DataFrame:
    """Read one of the supported formats.

    CSV has a header. Without a schema CSV and JSON types are inferred, which costs an extra pass
    over the text: give a schema for anything large. Parquet carries its own.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file type: {fmt}")
    settings = {"header": True, "inferSchema": schema is None, **options} if fmt == "csv" else options
    reader = spark.read.format(fmt).options(**settings)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_csv(spark: SparkSession, path: str | list[str], schema=None, **options) -> DataFrame:
    return read_file(spark, path, "csv", schema, **options)


def read_json(spark: SparkSession, path: str | list[str], schema=None, **options) -> DataFrame:
    return read_file(spark, path, "json", schema, **options)


def read_parquet(spark: SparkSession, path: str | list[str], schema=None, **options) -> DataFrame:
    return read_file(spark, path, "parquet", schema, **options)


def read_response(spark: SparkSession, path: str | list[str], schema=None) -> DataFrame:
    """A landed REST response body: a JSON object or array that may span lines."""
    return read_file(spark, path, "json", schema, multiLine=True)


def jdbc_options(
    url: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str = "org.postgresql.Driver",
    env: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Connection options; what is not given comes from JDBC_URL, DB_USER and DB_PASSWORD."""
    env = os.environ if env is None else env
    given = {"url": url or env.get("JDBC_URL"), "user": user or env.get("DB_USER")}
    missing = [name for name, value in given.items() if not value]
    if missing:
        raise ValueError(f"no database {' and '.join(missing)} given")
    return {**given, "password": password or env.get("DB_PASSWORD", ""), "driver": driver}


def read_query(spark: SparkSession, query: str, connection: Mapping[str, str], fetch_size: int = 10_000) -> DataFrame:
    """Result of a query the database evaluates itself; comes through one connection."""
    return (
        spark.read.format("jdbc").options(**connection).option("query", query).option("fetchsize", fetch_size).load()
    )


def read_table(
    spark: SparkSession,
    table: str,
    connection: Mapping[str, str],
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
) -> DataFrame:
    """A whole table over several connections, split on ranges of a numeric or date column.
    Rows outside the bounds are read too; the bounds only place the cuts."""
    cuts = {
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(**connection, **cuts).option("dbtable", table).load()
