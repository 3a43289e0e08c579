"""Layered Parquet storage and relational sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import ref, refs
from carelake.session import fresh_path, observed

LAYERS = ("bronze", "silver", "gold", "checkpoints", "ops")


@dataclass(frozen=True)
class LakeLayout:
    """Where the layers live below one root."""

    root: str

    def path(self, layer: str, table: str = "") -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return "/".join(part for part in (self.root.rstrip("/"), layer, table) if part)


@dataclass(frozen=True)
class Written:
    path: str
    rows: int


def balanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Lay rows out in files of the advisory size, rows of equal ``columns`` together. AQE splits
    a value that holds too much and merges values that hold little."""
    return df.hint("rebalance", *refs(columns)) if columns else df.hint("rebalance")


def write_layer(
    df: DataFrame,
    layout: LakeLayout,
    layer: str,
    table: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace_all: bool = False,
    placed: bool = False,
) -> Written:
    """Write Parquet and report the row count, observed during the write itself.

    Partitioned output is balanced on its partition columns first, unless it is ``placed`` so already;
    otherwise every task would open a file in every partition. Overwriting replaces only the partitions that rows are written
    to; ``replace_all`` replaces the table.
    """
    path = layout.path(layer, table)
    seen = Observation()
    out = balanced(df, partition_by) if partition_by and not placed else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by and not replace_all:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return Written(path, observed(seen, ["rows"], df)["rows"])


def read_layer(spark: SparkSession, layout: LakeLayout, layer: str, table: str, evolve: bool = False) -> DataFrame:
    """Read a stored table. ``evolve`` merges the schemas of files written at different times."""
    return spark.read.option("mergeSchema", str(evolve).lower()).parquet(layout.path(layer, table))


def append_evolving(df: DataFrame, layout: LakeLayout, layer: str, table: str, partition_by: Sequence[str] = ()) -> Written:
    """Append rows that may bring new columns; ``read_layer(evolve=True)`` sees all of them."""
    return write_layer(df, layout, layer, table, partition_by, mode="append")


def with_date(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add the partition column ``date``."""
    return df.withColumn("date", F.to_date(ref(column)))


def land_by_date(
    df: DataFrame,
    layout: LakeLayout,
    layer: str,
    table: str,
    column: str = "timestamp",
    mode: str = "overwrite",
    refine: Callable[[DataFrame], DataFrame] | None = None,
) -> Written:
    """Land rows by day. A day that rows are landed for is replaced whole, other days stay.

    ``refine`` makes the columns to land from each row by itself, its day unchanged: it runs where the
    rows have been brought to their days, so that what it adds is not shuffled."""
    dated = with_date(df, column)
    if refine is None:
        return write_layer(dated, layout, layer, table, ["date"], mode)
    placed = balanced(dated, ["date"]).drop("date").transform(refine)
    return write_layer(with_date(placed, column), layout, layer, table, ["date"], mode, placed=True)


def write_pair(df: DataFrame, csv_path: str, json_path: str, scratch: str | None = None) -> tuple[str, str]:
    """Land one half of the records as CSV with header and the other as JSON lines.

    Halves are chosen by a hash of the whole record: repeatable, and no row has to be counted. The
    records are stored once first, below ``scratch`` or the session's shared folder, so that both
    halves are of the same rows.
    """
    path = f"{scratch}/pair" if scratch else fresh_path(df.sparkSession, "pair")
    df.write.mode("overwrite").parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    side = F.pmod(F.xxhash64(*refs(df.columns)), F.lit(2))
    held.where(side == 0).write.mode("overwrite").csv(csv_path, header=True)
    held.where(side == 1).write.mode("overwrite").json(json_path)
    return csv_path, json_path


def layer_bytes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Stored bytes and files per layer. Only file listings are read, never contents."""
    whole: DataFrame | None = None
    for layer, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        sized = files.agg(
            F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"), F.count(F.lit(1)).alias("files")
        ).select(F.lit(layer).alias("layer"), F.lit("parquet").alias("format"), "size_bytes", "files")
        whole = sized if whole is None else whole.unionByName(sized)
    return whole


# -- relational sinks ----------------------------------------------------------------------------


def append_table(
    df: DataFrame, table: str, connection: Mapping[str, str], batch_size: int = 5_000, connections: int | None = None
) -> None:
    """Append from the executors in batches; an empty frame writes no row.

    Every task has a connection of its own, as many as the frame has partitions. ``connections`` is
    the most that the database bears: the frame is dealt to that many tasks by a shuffle, which leaves
    the stage that computes it as wide as it is. A task that is retried appends its batches once more;
    where that matters, append to a staging table and move its rows in one transaction.
    """
    out = df if connections is None else df.repartition(connections)
    writer = out.write.format("jdbc").options(**connection, batchsize=str(batch_size)).option("dbtable", table)
    writer.mode("append").save()


def without_generated(df: DataFrame) -> DataFrame:
    """Drop columns the target database fills itself."""
    return df.drop(*fx.GENERATED_COLUMNS)


def refresh_table(
    spark: SparkSession,
    table: str,
    source: Mapping[str, str],
    target: Mapping[str, str],
    batch_size: int = 5_000,
    split: Mapping[str, str] | None = None,
    fetch_size: int = 10_000,
    staging: str | None = None,
) -> None:
    """Replace the rows of a table by those of another database; the target's definition stays.
    An empty source leaves an empty target.

    ``split`` holds Spark's options for reading over several connections (partitionColumn, lowerBound,
    upperBound, numPartitions); without it one task reads the table. The target is emptied before it
    is filled, so a failure leaves it incomplete: name a ``staging`` table to fill that instead, and let
    the database swap the two.
    """
    reader = spark.read.format("jdbc").options(**source, fetchsize=str(fetch_size), **(split or {}))
    rows = reader.option("dbtable", table).load()
    writer = without_generated(rows).write.format("jdbc").options(**target).option("dbtable", staging or table)
    writer.option("truncate", "true").option("batchsize", batch_size).mode("overwrite").save()


def refresh_tables(
    spark: SparkSession, tables: Sequence[str], source: Mapping[str, str], target: Mapping[str, str]
) -> dict[str, str | None]:
    """Refresh several tables; one that fails is reported and does not stop the others."""
    outcome: dict[str, str | None] = {}
    for table in tables:
        try:
            refresh_table(spark, table, source, target)
            outcome[table] = None
        except Exception as failure:
            outcome[table] = f"{type(failure).__name__}: {failure}"
    return outcome
