"""Reproducible shuffle and sharding by a keyed permutation of global row numbers.

Rows are numbered in a total order. A Feistel network over a grid slightly larger than the number
of rows permutes the numbers; numbers that leave the range walk along their cycle until they are
back in it. Shard and slot are remainder and quotient of the permuted number, so shards differ by
at most one row, slots have no gaps, and either side can be computed from the other without data.

Defined results: a null text counts as no bytes, so its size is 1 and its checksum 0; null ids come
first in the order; rows equal in all columns are numbered one after the other; an empty table
gives no rows. Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import ranked, row_copies, whole

ROUNDS = 6
#: prime below 2^31: products of two remainders stay within 64 bits
PRIME = 2_147_483_647
#: walks taken before giving up; a grid of a * ceil(n / a) points has fewer than a outside of n
WALKS = 24


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three constants for each round."""
    keys = []
    for i in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}/{i}".encode()).digest()
        keys.append(tuple(1 + int.from_bytes(digest[8 * j : 8 * j + 8], "big") % (PRIME - 1) for j in range(3)))
    return keys


def _mix(half: Column, keys: tuple[int, int, int]) -> Column:
    a, b, c = (F.lit(k).cast("long") for k in keys)
    prime = F.lit(PRIME).cast("long")
    first = (half % prime * a + b) % prime
    return (first * first % prime + c) % prime


def _turn(i: int, keys: tuple[int, int, int], rows: Column, columns: Column) -> Callable[[Column], Column]:
    def left(h: Column) -> Column:
        return F.struct(((h["l"] + _mix(h["r"], keys)) % rows).alias("l"), h["r"].alias("r"))

    def right(h: Column) -> Column:
        return F.struct(h["l"].alias("l"), ((h["r"] + _mix(h["l"], keys)) % columns).alias("r"))

    return right if i % 2 else left


def _step(number: Column, rows: Column, columns: Column, seed: int) -> Column:
    """One pass of the network over the grid of `rows` x `columns` points."""
    halves = F.struct((number % rows).alias("l"), F.floor(number / rows).alias("r"))
    for i, keys in enumerate(round_keys(seed)):
        # the halves go through an array of one, which names them: the expression stays linear in the rounds
        halves = F.transform(F.array(halves), _turn(i, keys, rows, columns))[0]
    return halves["r"] * rows + halves["l"]


def permuted(number: Column, total: Column, seed: int) -> Column:
    """The number's image under the permutation of 0 to total - 1."""
    rows = F.greatest(F.ceil(F.sqrt(total.cast("double"))).cast("long"), F.lit(1).cast("long"))
    columns = F.greatest(F.floor((total + rows - 1) / rows).cast("long"), F.lit(1).cast("long"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        _step(number, rows, columns, seed),
        lambda x, _: F.when(x < total, x).otherwise(_step(x, rows, columns, seed)),
    )
    lost = F.raise_error(F.lit(f"no way back into the range within {WALKS} walks: choose another seed"))
    return F.when(walked < total, walked).otherwise(lost.cast("long"))


def permuted_plain(number: int, total: int, seed: int) -> int:
    """The same for one number on the driver, to find a row's shard without data."""
    rows = max(math.ceil(math.sqrt(total)), 1)
    columns = max((total + rows - 1) // rows, 1)
    while True:
        left, right = number % rows, number // rows
        for i, (a, b, c) in enumerate(round_keys(seed)):
            half = right if i % 2 == 0 else left
            first = (half % PRIME * a + b) % PRIME
            mixed = (first * first % PRIME + c) % PRIME
            if i % 2 == 0:
                left = (left + mixed) % rows
            else:
                right = (right + mixed) % columns
        number = right * rows + left
        if number < total:
            return number


def row_of(shard: int, slot: int, shards: int, total: int, seed: int) -> int:
    """The row number that lies at a slot: the network run backwards."""
    number = slot * shards + shard
    if not 0 <= number < total:
        raise ValueError("no such slot")
    rows = max(math.ceil(math.sqrt(total)), 1)
    columns = max((total + rows - 1) // rows, 1)
    keys = list(enumerate(round_keys(seed)))
    while True:
        left, right = number % rows, number // rows
        for i, (a, b, c) in reversed(keys):
            half = right if i % 2 == 0 else left
            first = (half % PRIME * a + b) % PRIME
            mixed = (first * first % PRIME + c) % PRIME
            if i % 2 == 0:
                left = (left - mixed) % rows
            else:
                right = (right - mixed) % columns
        number = right * rows + left
        if number < total:
            return number


def sharded(df: DataFrame, shards: int, seed: int, order: list[str]) -> DataFrame:
    """The rows with `row_number`, `shard` and `slot`. `order`: columns that order the rows; the
    others break ties. Columns must be comparable; columns of the three names are replaced."""
    df = df.drop("row_number", "shard", "slot", "_copy", "_total")
    rest = [c for c in df.columns if c not in order]
    numbered = ranked(row_copies(df, "_copy"), [*order, *rest, "_copy"], "row_number", "_total")
    place = permuted(F.col("row_number"), F.col("_total"), seed)
    return (
        numbered.withColumn("_at", place)
        .withColumn("shard", (F.col("_at") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("_at") / shards).cast("long"))
        .drop("_at", "_copy", "_total")
    )


def document_shards(docs: DataFrame, shards: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, size (bytes and 1), text_crc32, row_number, shard, slot."""
    keys = docs.select(
        F.col(id_col),
        (F.octet_length(whole(text_col)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(whole(text_col)).alias("text_crc32"),
    )
    return sharded(keys, shards, seed, [id_col, "size", "text_crc32"])


def write_shards(df: DataFrame, path: str, shards: int, seed: int, order: list[str]) -> None:
    """Whole rows as a table partitioned by shard, each sorted by slot."""
    placed = sharded(df, shards, seed, order)
    placed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def permutation_sql(rank: str, total: str, seed: int, relation: str) -> str:
    """The same permutation as standard SQL with a recursive walk, to check it by: columns of the
    relation, and `spot`."""
    left, right = "l0", "r0"
    lines = [f"n % {'a'} AS l0, n // a AS r0"]
    parts = []
    for i, (k1, k2, k3) in enumerate(round_keys(seed)):
        half = right if i % 2 == 0 else left
        first = f"(({half} % {PRIME}) * {k1} + {k2}) % {PRIME}"
        mixed = f"((({first}) * ({first})) % {PRIME} + {k3}) % {PRIME}"
        if i % 2 == 0:
            parts.append((f"({left} + {mixed}) % a AS l{i + 1}", f"{right} AS r{i + 1}"))
        else:
            parts.append((f"{left} AS l{i + 1}", f"({right} + {mixed}) % b AS r{i + 1}"))
        left, right = f"l{i + 1}", f"r{i + 1}"
    source = "SELECT rid, total, a, b, step, {0} FROM {{src}}".format(lines[0])
    for new_left, new_right in parts:
        source = f"SELECT rid, total, a, b, step, {new_left}, {new_right} FROM ({source})"
    network = f"SELECT rid, total, a, b, step + 1 AS step, {right} * a + {left} AS n FROM ({source})"
    return f"""grid AS (
  SELECT *, {rank} AS rid, {total} AS tot, greatest(CAST(ceil(sqrt({total})) AS BIGINT), 1) AS side FROM {relation}
), walk AS (
  {network.format(src="(SELECT rid, tot AS total, side AS a, greatest((tot + side - 1) // side, 1) AS b, 0 AS step, rid AS n FROM grid)")}
  UNION ALL
  {network.format(src="(SELECT * FROM walk WHERE n >= total)")}
), placed AS (
  SELECT grid.*, walk.n AS spot FROM grid JOIN walk ON grid.rid = walk.rid AND walk.n < walk.total
)"""


__all__ = ["document_shards", "permutation_sql", "permuted", "permuted_plain", "row_of", "sharded", "write_shards"]
