"""What the operators of this folder share: inputs, words, scratch tables, exact global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.session import fresh_path

#: a word: no ASCII white space inside
WORD = r"[^\x20\x09-\x0D]+"

#: bits that monotonically_increasing_id() leaves to the place within a partition
PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def plainly_named(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The rows under names that clash with none of the operators' own, the new name of each column,
    and the columns under their old names, to select in the end."""
    new = [f"_c{i}" for i in range(len(df.columns))]
    back = [F.col(n).alias(name) for n, name in zip(new, df.columns)]
    return df.toDF(*new), dict(zip(df.columns, new)), back


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows, written below the shared folder and read again, so that nothing before is ever
    computed twice and a lost executor repeats no earlier step."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_copies(df: DataFrame, copy: str) -> DataFrame:
    """The rows with the number of the copy (from 1) among rows that are equal in every column.

    Equal rows are counted before the shuffle and spread out after it, so however many there are,
    none of the steps behind has to hold them together.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_copies")


def ranked(df: DataFrame, order: list[str], rank: str, total: str | None = None) -> DataFrame:
    """The rows with their place (from 0) in the order, which must tell all rows apart.

    A range shuffle puts the rows into ordered partitions; the places within are stored, and the
    sizes of the partitions, one row for each, give the offsets. No task sees more than a partition.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stored(ordered.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", PLACE_BITS)
    sizes = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy()).alias("_all"),
    )
    # one row for each shuffle partition
    placed = held.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_offset") + F.col("_place") - F.shiftleft(F.col("_part"), PLACE_BITS)
    out = placed.withColumn(rank, place)
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_part", "_place", "_offset", "_all")
