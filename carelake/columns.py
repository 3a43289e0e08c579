"""Column-reference helpers that survive dots and back-ticks in names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref(name: str, of: str | None = None) -> Column:
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def refs(names: Iterable[str], of: str | None = None) -> list[Column]:
    return [ref(n, of) for n in names]


def any_of(conditions: Iterable[Column]) -> Column:
    joined = F.lit(False)
    for condition in conditions:
        joined = joined | condition
    return joined


def all_of(conditions: Iterable[Column]) -> Column:
    joined = F.lit(True)
    for condition in conditions:
        joined = joined & condition
    return joined


def instant(as_of) -> Column:
    """The reference clock: ``None`` reads the wall clock, otherwise a fixed instant. Text without
    a zone is in the session's time zone."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def before(as_of, hours: float) -> Column:
    """The instant a number of hours before the reference instant."""
    return F.timestamp_micros(F.unix_micros(instant(as_of)) - F.lit(int(hours * 3_600_000_000)))
