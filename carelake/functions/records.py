"""Expressions about a record as a whole: time, size, numbers, document check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake import fixed_values as fx


def event_instant(text: Column) -> Column:
    """Timestamp text in any form a cast reads; unreadable text gives null."""
    return text.try_cast("timestamp")


def strict_instant(text: Column) -> Column:
    """Timestamp text of exactly the exchanged form; other text gives null."""
    return F.try_to_timestamp(text, F.lit(fx.TEXT_TIMESTAMP_FORMAT))


def lag_ms(as_of: Column, at: Column) -> Column:
    """Whole seconds between two instants, in milliseconds."""
    return (F.unix_seconds(as_of) - F.unix_seconds(at.try_cast("timestamp"))) * F.lit(1000)


def json_length(*fields: Column) -> Column:
    """Characters of the record's JSON text; null fields are left out of that text."""
    return F.length(F.to_json(F.struct(*fields)))


def json_bytes(*fields: Column) -> Column:
    return F.octet_length(F.to_json(F.struct(*fields)))


def display_round(value: Column, digits: int = 1) -> Column:
    """Half-up rounding done on a decimal, so x.x5 rounds the way a numeric column does."""
    return F.round(value.cast("decimal(18,6)"), digits)


def nearest(value: Column, digits: int) -> Column:
    """Rounding of the scaled binary value, ties away from zero. Unlike ``round`` on a double it
    does not go through decimal text, so 0.1364499999999999 stays below the tie it prints as."""
    scale = F.lit(10.0**digits)
    scaled = value.cast("double") * scale
    whole = F.rint(scaled)
    tie = F.abs(scaled - whole) == 0.5
    return F.when(tie, scaled + F.signum(scaled) * 0.5).otherwise(whole) / scale


def ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent; a zero denominator gives null."""
    return F.round(F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")) * 100, digits)


def check_digits(nine_digits: Column) -> Column:
    """The two modulo-11 check digits that belong to a nine-digit number, as two-character text."""
    first = _mod11(nine_digits, 9)
    second = _mod11(F.concat(nine_digits, first), 10)
    return F.concat(first, second)


def cpf_is_valid(cpf: Column) -> Column:
    """True when the text holds eleven digits and its last two are the check digits of the rest."""
    digits = F.regexp_replace(cpf, r"\D", "")
    body = F.substring(digits, 1, 9)
    return (F.length(digits) == 11) & F.coalesce(
        F.substring(digits, 10, 2) == check_digits(body), F.lit(False)
    )


def _mod11(digits: Column, size: int) -> Column:
    """Weights run from ``size + 1`` down to 2; a remainder below 2 gives 0, else 11 minus it."""
    weighted = F.lit(0)
    for place in range(1, size + 1):
        digit = F.substring(digits, place, 1).try_cast("int")
        weighted = weighted + digit * F.lit(size + 2 - place)
    rest = weighted % 11
    return F.when(rest < 2, F.lit(0)).otherwise(F.lit(11) - rest).cast("string")
