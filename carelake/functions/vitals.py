"""Vital-sign expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake import fixed_values as fx


def whole_number(text: Column) -> Column:
    """Text to int; a decimal tail is cut off and anything else that is no number gives null."""
    return F.coalesce(
        text.try_cast("int"),
        F.regexp_extract(text, r"^([+-]?\d+)\.\d*$", 1).try_cast("int"),
    )


def pressure_reading(reading: Column, side: int) -> Column:
    """Side 0 (systolic) or 1 (diastolic) of a ``sys / dia`` text, null when absent or no number."""
    compact = F.translate(reading, " \t\n\x0b\f\r", "")
    return whole_number(F.split_part(compact, F.lit("/"), F.lit(side + 1)))


def pressure_class(systolic: Column, diastolic: Column) -> Column:
    """Low wins over high; a reading with no usable side counts as normal."""
    low = (systolic < fx.SYSTOLIC_LOW) | (diastolic < fx.DIASTOLIC_LOW)
    high = (systolic >= fx.SYSTOLIC_HIGH) | (diastolic >= fx.DIASTOLIC_HIGH)
    return _ladder((low, fx.PRESSURE_LOW_NAME), (high, fx.PRESSURE_HIGH_NAME))


def heart_rate_class(rate: Column) -> Column:
    return _ladder(
        (rate < fx.HEART_RATE_LOW, fx.HEART_SLOW_NAME),
        (rate > fx.HEART_RATE_HIGH, fx.HEART_FAST_NAME),
    )


def is_fever(temperature: Column) -> Column:
    """Compared as double, so a boundary reading of exactly the limit is a fever; null is not."""
    return F.coalesce(temperature.cast("double") >= F.lit(fx.FEVER_FROM), F.lit(False))


def _ladder(*steps: tuple[Column, str]) -> Column:
    """First step whose condition holds names the class; none gives the normal class."""
    named = [F.when(condition, F.lit(name)) for condition, name in steps]
    return F.coalesce(*named, F.lit(fx.NORMAL_NAME))
