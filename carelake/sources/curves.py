"""Layout along a space-filling curve, so that filters on any of several columns skip files.

Each column's value is replaced by its rank among sampled quantiles, so text, dates and numbers of any
distribution spread evenly over the ranks; a frequent value takes one rank, however many rows have it.
The bits of the ranks are interleaved, the highest bits of all columns first, and rows are
range-partitioned by the curve. The sample only places the ranks: rows are all kept, and files are narrow
in every column whether or not the sample was lucky.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.columns import ref, refs

#: rows that are sampled, bits of a rank, bits of one word of the curve
SAMPLE_ROWS, RANK_BITS, WORD_BITS = 20_000, 10, 62


def sampled_bounds(df: DataFrame, columns: Sequence[str], rank_bits: int = RANK_BITS, seed: int = 1) -> list[Column | None]:
    """For each column a sorted array of 2^rank_bits - 1 values that split a sample of about
    `SAMPLE_ROWS` rows evenly; None for a column without values."""
    slots = 1 << rank_bits
    total = df.count()
    picked = df.select(*[ref(c).alias(f"c{i}") for i, c in enumerate(columns)])
    sample = picked if total <= SAMPLE_ROWS else picked.sample(SAMPLE_ROWS / total, seed)
    # the sample is bounded, so each column of it may be one array
    sorted_values = [F.array_sort(F.collect_list(f"c{i}")).alias(f"c{i}") for i in range(len(columns))]

    def bounds(values: Column) -> Column:
        size = F.size(values)
        cut = F.transform(F.sequence(F.lit(1), F.lit(slots - 1)), lambda i: F.get(values, F.floor(i * size / slots).cast("int")))
        # a frequent value is several bounds, so that few values spread over all ranks too
        return F.filter(cut, lambda v: v.isNotNull())

    row = sample.agg(*sorted_values).select(*[bounds(F.col(f"c{i}")).alias(f"c{i}") for i in range(len(columns))])
    found = row.first()
    return [None if not values else F.array(*map(F.lit, values)).cast(row.schema[i].dataType) for i, values in enumerate(found)]


def rank(value: Column, bounds: Column, rank_bits: int = RANK_BITS) -> Column:
    """How many of the bounds are not above the value; 0 for null. A binary search, a bit at a time."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(rank_bits))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(bounds, at + width - 1) <= value, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def interleaved(ranks: Sequence[Column], rank_bits: int = RANK_BITS) -> list[Column]:
    """The curve as words of `WORD_BITS` bits: bit by bit from the highest, one of each rank in turn."""
    order = [(r, b) for b in reversed(range(rank_bits)) for r in ranks]
    words = []
    for first in range(0, len(order), WORD_BITS):
        part = order[first : first + WORD_BITS]
        word = F.lit(0).cast("long")
        for place, (r, b) in enumerate(reversed(part)):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long")
            word = word.bitwiseOR(F.shiftleft(bit, place))
        words.append(word)
    return words


def zordered(df: DataFrame, columns: Sequence[str], files: int | None = None, rank_bits: int = RANK_BITS) -> DataFrame:
    """The rows, range-partitioned and sorted along the curve of these columns. A row hash ends the
    range key, so rows that agree in all ranks may spread over several files."""
    bounds = sampled_bounds(df, columns, rank_bits)
    ranks = [f"__rank{i}" for i in range(len(columns))]
    placed = df.withColumns({n: F.lit(0) if b is None else rank(ref(c), b, rank_bits) for n, c, b in zip(ranks, columns, bounds)})
    words = {f"__curve{i}": w for i, w in enumerate(interleaved([F.col(n) for n in ranks], rank_bits))}
    placed = placed.withColumns(words).drop(*ranks)
    key = [F.col(w) for w in words]
    order = [*key, F.xxhash64(*refs(df.columns))]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*key).drop(*words)
