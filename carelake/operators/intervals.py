"""Joins of values with the intervals they lie in, on equal bins instead of all pairs.

An interval belongs to the level whose bins, a power of two wide, are at least as wide as the interval,
so it touches two bins at most however wide it is; a value has one bin on each level that some
interval is on. Intervals of one value share a level whose bins are the values themselves, whatever
their size. Value and interval meet in one bin or none. Bins only bring rows together: the
caller's condition decides, so rounding of the numbers behind the bins loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL, BIN = "__level", "__bin"
#: numbers beyond this count as this when bins are chosen; levels are within the powers of a double
_MOST, _FINEST = 1e300, -1000
#: the level of intervals of one value, below all others
POINT = -2000


def number(df: DataFrame, value: Column) -> Column:
    """A double that orders as the value does: of a number, a date or a timestamp."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.NumericType):
        plain = value.cast("double")
    elif isinstance(kind, T.DateType):
        plain = F.unix_date(value).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        plain = F.unix_micros(value.cast("timestamp")).cast("double")
    else:
        raise TypeError(f"{kind.simpleString()} values have no bins")
    # null stays null; NaN, above all numbers, becomes the largest
    return F.when(plain.isNotNull(), F.greatest(F.least(plain, F.lit(_MOST)), F.lit(-_MOST)))


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), F.greatest(level, F.lit(_FINEST)).cast("double"))


def _bin(x: Column, level: Column) -> Column:
    return F.floor(x / _width(level))


def binned_intervals(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """The rows with the level of their interval, once for each of the one or two bins that it
    touches; rows without an interval, or with an empty one, are left out."""
    a, b = number(df, low), number(df, high)
    # no finer than neighbouring doubles of this size, so that bin numbers are exact
    size = F.greatest(F.abs(a), F.abs(b))
    finest = F.when(size > 0, F.ceil(F.log2(size)) - 52).otherwise(F.lit(_FINEST))
    own = F.when(b > a, F.greatest(finest, F.ceil(F.log2(b - a)), F.lit(_FINEST))).otherwise(F.lit(POINT))
    placed = df.withColumns({"__a": a, "__b": b}).where(F.col("__a") <= F.col("__b"))
    placed = placed.withColumn(LEVEL, own.cast("int"))
    wide = F.sequence(_bin(F.col("__a"), F.col(LEVEL)), _bin(F.col("__b"), F.col(LEVEL))).cast("array<double>")
    bins = F.when(F.col(LEVEL) > POINT, wide).otherwise(F.array("__a"))
    return placed.withColumn(BIN, F.explode(bins)).drop("__a", "__b")


def levels(intervals: DataFrame) -> list[int]:
    """The levels that some interval is on; a few dozen at most."""
    return sorted(r[0] for r in intervals.select(LEVEL).distinct().collect())


def binned_values(df: DataFrame, value: Column, on_levels: list[int]) -> DataFrame:
    """The rows with a value, once for each level, with its bin there. Where a level is too fine for a
    value, no interval of it can hold the value."""
    x = number(df, value)
    spread = df.withColumn("__x", x).where("__x IS NOT NULL").withColumn(LEVEL, F.explode(F.lit(on_levels).cast("array<int>")))
    point, level = F.col(LEVEL) == POINT, F.col(LEVEL)
    near = F.abs(F.col("__x") / _width(level)) < F.lit(float(2**60))
    own = F.when(point, F.col("__x")).otherwise(_bin(F.col("__x"), level).cast("double"))
    return spread.where(point | near).withColumn(BIN, own).drop("__x")
