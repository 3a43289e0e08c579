"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import stored


#: pairs written to one file
ROWS_A_FILE = 500_000


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around the node."""
    both = pairs.union(pairs.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_u"), F.least("a", "_m").alias("_m"))
    return both.join(least, both["a"] == least["_u"]).where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_u"), "_m")
    inner = pairs.join(least, pairs["a"] == least["_u"]).where("b > _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return inner.union(least.select("_u", "_m")).distinct()


def _mark(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(pairs: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node of the pairs `a`, `b`
    that is not itself a root. Nodes must be comparable and not null; pairs of a node with itself
    do not count. Each round's pairs are stored, so only a count and a checksum reach the driver.
    """
    held = stored(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "pairs"
    )
    mark = _mark(held)
    while mark[0]:
        # few files for few pairs; a round never makes more of them
        files = 1 + mark[0] // ROWS_A_FILE
        held = stored(_small_star(_large_star(held)).repartition(files), "pairs")
        mark, before = _mark(held), mark
        if mark == before:
            break
    return held.select(F.col("a").alias("node"), F.col("b").alias("root"))
