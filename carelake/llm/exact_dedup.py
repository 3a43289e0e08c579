"""Exact deduplication by a 128-bit content hash, with the bytes compared inside groups.

Only keys are grouped: id and hash of each row, with map-side counts, so a group that holds a third
of all rows is a few counters per task. Texts move only for hashes that occur more than once, and
equal ones collapse before the shuffle. Where two different texts share a hash, the texts
themselves tell their groups apart.

A hash of more than one in `MOST_HOT` of all rows is hot; there are fewer than `MOST_HOT` of them,
whatever the data. Their rows are dealt over `SALTS` parts by id, for joins of texts and of ids
alike, and equal texts collapse within a part before the parts meet.

Defined results: null counts as the empty text; null ids are larger than none and smaller than all
others, so they stay only where a group has no other; of rows that repeat both id and text one is
kept; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import plainly_named, stored, whole

#: a hash is hot from this share of all rows on, so fewer hashes than this are
MOST_HOT = 4096
#: parts that a hot hash is dealt over
SALTS = 256
#: copies of one row that are numbered at once
CHUNK = 65_536


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame, id_col: str, text_col: str, normalise: Callable | None, hashed: Callable) -> DataFrame:
    text = whole(text_col)
    text = normalise(text) if normalise else text
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_hash", hashed(F.col("_text")))


def _repeated(keyed: DataFrame) -> DataFrame:
    """`_hash` of more than one row, and whether it is `_hot`."""
    counted = stored(keyed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated-hashes")
    return counted.select("_hash", (F.col("_n") > keyed.count() / MOST_HOT).alias("_hot"))


def _dealt(rows: DataFrame, repeated: DataFrame, by: Column) -> DataFrame:
    """Adds `_salt`, the part of a row: 0 unless its hash is hot."""
    # fewer than MOST_HOT rows
    hot = F.broadcast(repeated.where("_hot"))
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    return rows.join(hot, "_hash", "left").withColumn("_salt", part).drop("_hot")


def _for_all_parts(rows: DataFrame) -> DataFrame:
    """The rows, those that are `_hot` once for each part that theirs are dealt over."""
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_salt", F.explode(parts)).drop("_hot")


def _collisions(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Different texts of one hash, numbered from 1: `_hash`, `_text`, `_variant`."""
    # grouped as one value, which is no key of the join: copies collapse in each task before they are
    # shuffled again, and Spark may split the join's large partitions
    pair = F.struct("_hash", "_text").alias("_pair")
    several = keyed.select("_hash", "_salt", "_text").join(_for_all_parts(repeated), ["_hash", "_salt"], "left_semi")
    texts = several.groupBy(pair).agg(F.count(F.lit(1)).alias("_n")).select("_pair._hash", "_pair._text")
    clashing = texts.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    by_text = Window.partitionBy("_hash").orderBy("_text")
    return (
        texts.join(clashing, "_hash", "left_semi")
        .withColumn("_variant", F.row_number().over(by_text))
        .select("_hash", "_text", "_variant")
    )


def classified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row for each row of `docs`: id, keep_id, group_size, kept, text_sha256.

    `keep`: which id of a group stays, the "smallest" or the "largest". `normalise` gives the text
    that is compared.
    """
    keyed = _keyed(docs, id_col, text_col, normalise, hashed)
    repeated = _repeated(keyed)
    keyed = _dealt(keyed, repeated, F.col("_id"))
    collisions = _collisions(keyed, repeated)
    if collisions.isEmpty():
        keyed = keyed.withColumn("_variant", F.lit(0))
    else:
        keyed = keyed.join(collisions, ["_hash", "_text"], "left").fillna(0, ["_variant"])
    ids = (
        keyed.select("_id", "_hash", "_salt", "_variant", F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"))
        .groupBy("_id", "_hash", "_salt", "_variant", "_sha")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    best = F.min("_id") if keep == "smallest" else F.max("_id")
    groups = (
        ids.groupBy("_hash", "_variant")
        .agg(F.sum("_rows").alias("_size"), best.alias("_keep"))
        .where("_size > 1")
    )
    hot = F.broadcast(repeated.where("_hot"))
    groups = _for_all_parts(groups.join(hot, "_hash", "left"))
    joined = ids.join(groups, ["_hash", "_salt", "_variant"], "left")
    joined = joined.withColumn("_keep", F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")))
    # chunks first, so that no row holds the numbers of all its copies
    chunks = joined.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"), F.lit(CHUNK).cast("long"))))
    last = F.least(F.col("_rows"), F.col("_from") + (CHUNK - 1))
    one_each = chunks.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    return one_each.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns."""
    docs, named, back = plainly_named(docs)
    id_col, text_col = named[id_col], named[text_col]
    marks = classified(docs, id_col, text_col, keep)
    decided = marks.where("group_size > 1").groupBy(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_sha"))
    decided = decided.agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
    signed = docs.withColumn("_sha", F.unhex(F.sha2(whole(text_col), 256)))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (signed["_sha"] == F.col("_sha_of"))
    decided = decided.withColumnRenamed("_sha", "_sha_of")
    dropped = decided.where(~F.col("_kept"))
    rest = signed.join(dropped, same, "left_anti")
    repeated = decided.where(F.col("_kept") & (F.col("_rows") > 1))
    if repeated.isEmpty():
        return rest.select(*back)
    once = rest.join(repeated, same, "left_semi").dropDuplicates([id_col, "_sha"])
    return rest.join(repeated, same, "left_anti").unionByName(once).select(*back)
