"""Data-quality reports, scores, profiles and alerts, each from one or two passes over the data.

Null counts, domain rules and newest instants are plain aggregates. Copies of whole rows are counted
by a hash of the row: only hashes are shuffled, and only rows whose hash shares a slot with one that
occurs more than once are compared whole, so the count is exact at the cost of a second scan. Keys
are narrow and are grouped as they are, everything else combined map-side along with them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import fixed_values as fx
from carelake.columns import instant, ref, refs
from carelake.functions import records

COPIES, HASH, SLOT = "__copies", "__hash", "__slot"
#: hashes that occur more than once mark one of this many slots; the marks are sent to every task
SLOTS = 2**21


# -- building blocks -----------------------------------------------------------------------------


def row_groups(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (or keys) with the number of times each occurs."""
    return df.groupBy(*refs(keys or df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def domain_rules(columns: Sequence[str]) -> dict[str, Column]:
    """The rules whose column is present, as boolean expressions (null counts as invalid)."""
    rules = {c: ref(c).between(*bounds) for c, bounds in fx.VALID_RANGES.items() if c in columns}
    rules.update({c: ref(c).isin(*codes) for c, codes in fx.VALID_CODES.items() if c in columns})
    return rules


def _explode_columns(one_row: DataFrame, per_column: Mapping[str, Mapping[str, Column]], *keep: str) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column."""
    entries = [
        F.struct(F.lit(name).alias("column"), *[v.alias(k) for k, v in values.items()])
        for name, values in per_column.items()
    ]
    return one_row.select(*keep, F.inline(F.array(*entries)))


def _pct(part: Column, whole: Column, digits: int | None = 2) -> Column:
    share = F.coalesce(F.try_divide(part, whole), F.lit(0.0)) * 100
    return share if digits is None else records.nearest(share, digits)


# -- basic report --------------------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Null count, ratio and percentage of every column: one aggregate without a data shuffle."""
    columns = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(ref(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    total = F.col("total_records")
    return _explode_columns(
        counted,
        {
            c: {
                "null_count": F.col(f"n{i}"),
                "null_ratio": F.coalesce(F.try_divide(F.col(f"n{i}"), total), F.lit(0.0)),
                "null_pct": _pct(F.col(f"n{i}"), total),
            }
            for i, c in enumerate(columns)
        },
        "total_records",
    )


def row_counts(df: DataFrame, row_hash: Column | None = None) -> DataFrame:
    """One row: ``total_records`` and ``distinct_records``, exact.

    Rows are grouped by their hash. A hash that occurs more than once marks its slot: rows of marked
    slots are grouped whole, which also tells apart rows that share a hash; in the other slots every
    hash is one distinct row. Rows are chosen by a broadcast of the marks, which `SLOTS` bounds, so the
    rows of other slots are never shuffled.
    """
    return _counted_rows(df, row_hash).select("total_records", "distinct_records")


#: columns whose nulls one number tells
_MASK_BITS = 62


def _counted_rows(df: DataFrame, row_hash: Column | None = None, with_nulls: bool = False) -> DataFrame:
    """``row_counts`` and, if asked for, the null count of column i as ``n<i>``. Which columns are null
    is a number beside the hash: rows that are equal agree in it, so it makes no more groups, and
    null counts need no scan of their own."""
    names = df.columns
    signed = df.withColumn(HASH, F.xxhash64(*refs(names)) if row_hash is None else row_hash)
    keys = [HASH]
    for first in range(0, len(names) if with_nulls else 0, _MASK_BITS):
        bits = [F.when(ref(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(names[first : first + _MASK_BITS])]
        keys.append(f"{HASH}{first}")
        signed = signed.withColumn(keys[-1], reduce(lambda a, b: a.bitwiseOR(b), bits))
    slot = F.coalesce(F.pmod(F.hash(HASH), F.lit(SLOTS)), F.lit(0)).alias(SLOT)
    hashes = signed.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).select("*", slot)
    marks = F.broadcast(hashes.where(F.col(COPIES) > 1).select(SLOT).distinct().withColumn("__marked", F.lit(True)))

    def nulls(i: int) -> Column:
        bit = F.shiftright(F.col(keys[1 + i // _MASK_BITS]), i % _MASK_BITS).bitwiseAND(F.lit(1))
        return F.coalesce(F.sum(F.col(COPIES) * bit), F.lit(0))

    counted = [f"n{i}" for i in range(len(names) if with_nulls else 0)]
    once = F.count_if(F.col("__marked").isNull())
    by_hash = hashes.join(marks, SLOT, "left").agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("total_records"),
        once.alias("distinct_records"),
        *[nulls(i).alias(n) for i, n in enumerate(counted)],
    )
    several = signed.select("*", slot).join(marks, SLOT, "left_semi")
    whole = several.groupBy(*refs(names)).agg(F.count(F.lit(1)).alias(COPIES))
    nothing = F.lit(0).cast("bigint")
    by_row = whole.agg(
        nothing.alias("total_records"), F.count(F.lit(1)).alias("distinct_records"), *[nothing.alias(n) for n in counted]
    )
    sums = ["total_records", "distinct_records", *counted]
    return by_hash.unionByName(by_row).agg(*[F.sum(c).alias(c) for c in sums])


def _totals(df: DataFrame) -> DataFrame:
    """One row: all rows, surplus copies, and the null count of column i as ``n<i>``."""
    surplus = F.col("total_records") - F.col("distinct_records")
    return _counted_rows(df, with_nulls=True).select("*", surplus.alias("duplicates")).drop("distinct_records")


def quality_report(df: DataFrame, stage: str = "") -> DataFrame:
    """One row: totals, duplicates, and maps with the null count and percentage of the columns
    that have nulls."""
    columns = df.columns
    counts = F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(f"n{i}") for i in range(len(columns))])
    )
    with_nulls = F.map_filter(counts, lambda _, n: n > 0)
    total = F.col("total_records")
    return _totals(df).select(
        F.lit(stage).alias("stage"),
        total,
        F.lit(len(columns)).alias("columns"),
        with_nulls.alias("null_columns"),
        F.transform_values(with_nulls, lambda _, n: _pct(n, total)).alias("null_pct"),
        "duplicates",
    )


def duplicate_report(df: DataFrame, layer: str = "") -> DataFrame:
    """Total rows, distinct rows, surplus copies and their share."""
    surplus = F.col("total_records") - F.col("distinct_records")
    return row_counts(df).select(
        F.lit(layer).alias("layer"),
        "total_records",
        "distinct_records",
        surplus.alias("duplicates"),
        F.coalesce(F.try_divide(surplus, F.col("total_records")), F.lit(0.0)).alias("duplicate_ratio"),
    )


def threshold_alerts(df: DataFrame, limit_pct: float = fx.NULL_ALERT_PCT) -> DataFrame:
    """A WARNING row per column whose null percentage is above the limit; an empty frame gives a
    single ERROR row."""
    columns = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(ref(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    total = F.col("total")

    def entry(severity: str, name: Column, pct: Column) -> Column:
        return F.struct(
            F.lit(severity).alias("severity"), name.alias("column"), pct.cast("double").alias("null_pct")
        )

    warnings = F.filter(
        F.array(
            *[entry("WARNING", F.lit(c), _pct(F.col(f"n{i}"), total, None)) for i, c in enumerate(columns)]
        ),
        lambda alert: alert["null_pct"] > limit_pct,
    )
    nothing = F.array(entry("ERROR", F.lit(None).cast("string"), F.lit(None)))
    return counted.select(F.inline(F.when(total == 0, nothing).otherwise(warnings)))


def report_alerts(report: DataFrame, limit_pct: float = fx.NULL_ALERT_PCT) -> DataFrame:
    """The rows of ``threshold_alerts``, with their ``stage``, from quality reports alone."""
    total = F.col("total_records")

    def entry(severity: str, name: Column, pct: Column) -> Column:
        return F.struct(F.lit(severity).alias("severity"), name.alias("column"), pct.cast("double").alias("null_pct"))

    shares = F.transform(
        F.map_entries("null_columns"), lambda e: entry("WARNING", e["key"], _pct(e["value"], total, None))
    )
    above = F.filter(shares, lambda alert: alert["null_pct"] > limit_pct)
    nothing = F.array(entry("ERROR", F.lit(None).cast("string"), F.lit(None)))
    return report.select("stage", F.inline(F.when(total == 0, nothing).otherwise(above)))


# -- scores --------------------------------------------------------------------------------------


def _timeliness(latest: Column, kind: T.DataType | None, as_of: Column, max_age_hours: float) -> Column:
    """1 at the reference instant, 0 at the age limit or beyond; future instants exceed 1."""
    if kind is None:
        return F.lit(1.0)
    if isinstance(kind, T.StringType):
        newest = records.strict_instant(latest)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        newest = latest.cast("timestamp")
    else:
        newest = F.lit(None).cast("timestamp")
    age_hours = (F.unix_micros(as_of) - F.unix_micros(newest)) / F.lit(3_600_000_000.0)
    score = F.greatest(F.lit(0.0), F.lit(1.0) - age_hours / F.lit(float(max_age_hours)))
    return F.when(latest.isNull(), F.lit(0.0)).when(newest.isNull(), F.lit(0.5)).otherwise(score)


def scorecard(
    df: DataFrame,
    layer: str = "",
    keys: Sequence[str] | None = None,
    timestamp_column: str = "timestamp",
    max_age_hours: float = fx.MAX_AGE_HOURS,
    as_of=None,
) -> DataFrame:
    """Completeness, uniqueness, consistency, timeliness and their weighted score, one row.

    All parts come from a single grouping by the keys (or whole rows): each group carries its row
    count, null cells, rule hits and newest instant, combined map-side before the shuffle.
    """
    columns = df.columns
    rules = list(domain_rules(columns).values())
    kind = df.schema[timestamp_column].dataType if timestamp_column in columns else None

    null_cells = F.lit(0)
    for c in columns:
        null_cells = null_cells + ref(c).isNull().cast("int")
    parts = {
        "rows": F.count(F.lit(1)),
        "nulls": F.sum(null_cells),
        **{f"ok{i}": F.count_if(rule) for i, rule in enumerate(rules)},
    }
    if kind is not None:
        parts["newest"] = F.max(ref(timestamp_column))
    groups = df.groupBy(*refs(keys or columns)).agg(*[v.alias(f"__{k}") for k, v in parts.items()])

    folded = groups.agg(
        F.count(F.lit(1)).alias("groups"),
        *[F.coalesce(F.sum(f"__{k}"), F.lit(0)).alias(k) for k in parts if k != "newest"],
        *([F.max("__newest").alias("newest")] if kind is not None else []),
    )
    rows = F.col("rows")
    hits = [F.try_divide(F.col(f"ok{i}"), rows) for i in range(len(rules))]
    measured = {
        "completeness": 1.0 - F.try_divide(F.col("nulls"), rows * len(columns)),
        "uniqueness": F.try_divide(F.col("groups"), rows),
        "consistency": sum(hits[1:], hits[0]) / len(hits) if hits else F.lit(1.0),
        "timeliness": _timeliness(
            F.col("newest") if kind is not None else F.lit(None), kind, instant(as_of), max_age_hours
        ),
    }
    scored = folded.select(
        rows.alias("total_records"),
        *[F.when(rows > 0, part).otherwise(0.0).alias(name) for name, part in measured.items()],
    )
    weighted = [F.col(name) * weight for name, weight in fx.SCORE_WEIGHTS.items()]
    return scored.withColumn("dqs_score", sum(weighted[1:], weighted[0])).select(
        F.lit(layer).alias("layer"),
        "total_records",
        F.lit(len(columns)).alias("total_columns"),
        *[records.nearest(F.col(name), 4).alias(name) for name in (*fx.SCORE_WEIGHTS, "dqs_score")],
    )


def completeness(df: DataFrame) -> DataFrame:
    """Share of cells that are set. Needs no shuffle of rows."""
    cells = F.lit(0)
    for c in df.columns:
        cells = cells + ref(c).isNull().cast("int")
    share = F.try_divide(F.sum(cells), F.count(F.lit(1)) * len(df.columns))
    return df.agg(F.coalesce(1.0 - share, F.lit(0.0)).alias("completeness"))


def uniqueness(
    df: DataFrame, keys: Sequence[str] | None = None, relative_error: float | None = None
) -> DataFrame:
    """Distinct rows or keys over all rows; null is a key value like any other.

    With ``relative_error`` the distinct count is estimated by a sketch, which needs no shuffle.
    """
    if relative_error is None:
        counted = row_counts(df.select(*refs(keys or df.columns)))
        share = F.try_divide(F.col("distinct_records"), F.col("total_records"))
        return counted.select(F.coalesce(share, F.lit(0.0)).alias("uniqueness"))
    distinct = F.approx_count_distinct(F.xxhash64(*refs(keys or df.columns)), relative_error)
    share = F.least(F.try_divide(distinct, F.count(F.lit(1))), F.lit(1.0))
    return df.agg(F.coalesce(share, F.lit(0.0)).alias("uniqueness"))


def consistency(df: DataFrame) -> DataFrame:
    """Unweighted mean of the valid share of each rule that applies; 1 when none does."""
    rules = list(domain_rules(df.columns).values())
    if not rules:
        return df.agg(F.lit(1.0).alias("consistency"))
    shares = [F.mean(F.when(rule, 1.0).otherwise(0.0)) for rule in rules]
    return df.agg((sum(shares[1:], shares[0]) / len(shares)).alias("consistency"))


def latest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(ref(column)).alias("latest"))


def timeliness(
    df: DataFrame, column: str = "timestamp", max_age_hours: float = fx.MAX_AGE_HOURS, as_of=None
) -> DataFrame:
    if column not in df.columns:
        return df.agg(F.lit(1.0).alias("timeliness"))
    kind = df.schema[column].dataType
    return latest(df, column).select(
        _timeliness(F.col("latest"), kind, instant(as_of), max_age_hours).alias("timeliness")
    )


# -- profile -------------------------------------------------------------------------------------


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _exact_value(field: T.StructField) -> dict[str, Column]:
    """The value in one of three typed slots; two values are equal exactly when their slots are.
    Numbers and instants keep fixed-width slots, which are far cheaper to group than text."""
    value, kind = ref(field.name), field.dataType
    slots: dict[str, Column] = {}
    if isinstance(kind, _WHOLE):
        slots["whole"] = value
    elif isinstance(kind, T.BooleanType):
        slots["whole"] = value.cast("int")
    elif isinstance(kind, T.DateType):
        slots["whole"] = F.unix_date(value)
    elif isinstance(kind, T.TimestampType):
        slots["whole"] = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        slots["real"] = value
    elif isinstance(kind, T.BinaryType):
        slots["text"] = F.hex(value)
    elif isinstance(kind, _NESTED):
        form = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
        slots["text"] = F.to_json(value, form)
    else:
        slots["text"] = value
    return {
        "whole": slots.get("whole", F.lit(None)).cast("bigint"),
        "real": slots.get("real", F.lit(None)).cast("double"),
        "text": slots.get("text", F.lit(None)).cast("string"),
    }


def _value_groups(df: DataFrame) -> DataFrame:
    """Distinct values of every column with their number of occurrences. The unpivoted rows are
    narrow and are aggregated map-side, so neither a dominant value nor a wide table inflates the
    shuffle. ``at`` is the column's position."""
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("at"), *[v.alias(k) for k, v in _exact_value(f).items()])
            for i, f in enumerate(df.schema.fields)
        ]
    )
    grouped = df.select(F.inline(slots)).groupBy("at", "whole", "real", "text")
    return grouped.agg(F.count(F.lit(1)).alias("occurrences"))


_MEASURES = {
    "min": F.min,
    "max": F.max,
    "mean": lambda v: records.nearest(F.mean(v), 4),
    "stddev": lambda v: records.nearest(F.stddev_samp(v), 4),
}


def _numeric_stats(df: DataFrame) -> dict[str, dict[str, Column]]:
    """Aggregates for the numeric columns, by column and measure."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return {c: {k: f(ref(c)).cast("double") for k, f in _MEASURES.items()} for c in numbers}


def _exact_profile(df: DataFrame) -> DataFrame:
    """The profile from the value groups: the deviations need the means, so the groups, not the
    source, are gone through twice."""
    # the second groupings are partial per task, so even an all-distinct column sends one row per task
    groups, n = _value_groups(df), F.col("occurrences")
    kinds = {i: f.dataType for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, T.NumericType)}
    written = [i for i, kind in kinds.items() if isinstance(kind, T.DecimalType)]
    number = F.coalesce(F.col("real"), F.col("whole").cast("double"))
    if written:
        number = F.when(F.col("at").isin(written), F.col("text").cast("double")).otherwise(number)
    value = F.when(F.col("at").isin(list(kinds)), number) if kinds else F.lit(None).cast("double")
    valued = groups.withColumn("value", value)
    total, present = F.sum(n), F.sum(F.when(F.col("value").isNotNull(), n))
    empty = F.col("whole").isNull() & F.col("real").isNull() & F.col("text").isNull()
    missing = F.coalesce(F.sum(F.when(empty, n)), F.lit(0))
    distinct = F.count(F.lit(1))
    first = valued.groupBy("at").agg(
        missing.alias("null_count"),
        _pct(missing, total).alias("null_pct"),
        distinct.alias("distinct_count"),
        _pct(distinct, total).alias("distinct_pct"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.try_divide(F.sum(F.col("value") * n), present).alias("middle"),
    )
    # one row per column
    means = F.broadcast(first.select(F.col("at").alias("of"), "middle"))
    off = F.col("value") - F.col("middle")
    deviation = F.sqrt(F.try_divide(F.sum(off * off * n), present - 1))
    second = valued.join(means, F.col("at") == F.col("of")).groupBy("of").agg(F.when(present > 1, deviation).alias("deviation"))
    named = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("at") + 1)
    return first.join(F.broadcast(second), F.col("at") == F.col("of")).select(
        named.alias("column"),
        *first.columns[1:5],
        "min",
        "max",
        records.nearest(F.col("middle"), 4).alias("mean"),
        records.nearest(F.col("deviation"), 4).alias("stddev"),
    )


def column_profile(df: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Null and distinct count and share per column (null is a value of its own), and
    min / max / mean / sample standard deviation of numeric columns.

    Exact distinct counts shuffle every distinct value once, and all measures come from these. With
    ``relative_error`` they are estimated by sketches instead and the whole profile is one aggregate
    without a shuffle.
    """
    if relative_error is None:
        return _exact_profile(df)
    stats = _numeric_stats(df)
    blank = {k: F.lit(None).cast("double") for k in _MEASURES}
    place = {c: i for i, c in enumerate(df.columns)}
    wide = [m.alias(f"{k}{place[c]}") for c, measures in stats.items() for k, m in measures.items()]

    def measured(c: str) -> dict[str, Column]:
        return {k: F.col(f"{k}{place[c]}") for k in _MEASURES} if c in stats else blank

    total = F.col("total")
    counts = [F.count_if(ref(c).isNull()).alias(f"n{i}") for c, i in place.items()]
    sketches = [
        F.approx_count_distinct(F.when(ref(c).isNotNull(), F.xxhash64(ref(c))), relative_error).alias(f"d{i}")
        for c, i in place.items()
    ]
    folded = df.agg(F.count(F.lit(1)).alias("total"), *counts, *sketches, *wide)

    def counted_columns(i: int) -> dict[str, Column]:
        nulls = F.col(f"n{i}")
        distinct = F.col(f"d{i}") + F.when(nulls > 0, 1).otherwise(0)
        return {
            "null_count": nulls,
            "null_pct": _pct(nulls, total),
            "distinct_count": distinct,
            "distinct_pct": _pct(distinct, total),
        }

    return _explode_columns(folded, {c: {**counted_columns(i), **measured(c)} for c, i in place.items()})


def anomalies(profile: DataFrame, null_limit_pct: float = fx.NULL_ALERT_PCT) -> DataFrame:
    """Suspicious columns of a profile: many nulls, one value only, no variance."""

    def finding(kind: str, when: Column, value: Column, limit: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(kind).alias("type"),
                F.col("column"),
                value.cast("double").alias("value"),
                limit.cast("double").alias("threshold"),
                F.lit(fx.FINDINGS[kind]).alias("severity"),
            ),
        )

    none = F.lit(None)
    distinct, nulls = F.col("distinct_count"), F.col("null_count")
    found = F.array(
        finding("high_null_ratio", F.col("null_pct") > null_limit_pct, F.col("null_pct"), F.lit(null_limit_pct)),
        finding("constant_column", (distinct == 1) & (nulls == 0), none, none),
        finding("zero_variance", (F.col("stddev") == 0) & (distinct > 1), none, none),
    )
    return profile.select(F.inline(F.array_compact(found)))


def suspicious(df: DataFrame, null_limit_pct: float = fx.NULL_ALERT_PCT) -> DataFrame:
    """``anomalies`` of the rows from one aggregate without a shuffle of values: whether a column has
    one value or more is whether its smallest and largest differ, so nothing is counted exactly."""
    stats = _numeric_stats(df)
    aggregates = [F.count(F.lit(1)).alias("total")]
    for i, field in enumerate(df.schema.fields):
        value = F.coalesce(*[v.cast("string") for v in _exact_value(field).values()]) if isinstance(field.dataType, _NESTED) else ref(field.name)
        aggregates += [
            F.count_if(ref(field.name).isNull()).alias(f"n{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
            (stats[field.name]["stddev"] if field.name in stats else F.lit(None).cast("double")).alias(f"deviation{i}"),
        ]
    folded = df.agg(*aggregates)

    def of(i: int) -> dict[str, Column]:
        nulls, total = F.col(f"n{i}"), F.col("total")
        values = F.when(total == nulls, 0).when(F.col(f"low{i}") == F.col(f"high{i}"), 1).otherwise(2)
        return {
            "null_count": nulls,
            "null_pct": _pct(nulls, total),
            "distinct_count": (values + F.when(nulls > 0, 1).otherwise(0)).cast("bigint"),
            "stddev": F.col(f"deviation{i}"),
        }

    return anomalies(_explode_columns(folded, {c: of(i) for i, c in enumerate(df.columns)}), null_limit_pct)


# -- gauges --------------------------------------------------------------------------------------


def gauges(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Null ratio per column, duplicate ratio and active rows of each layer in long form."""
    whole: DataFrame | None = None
    for layer, df in layers.items():
        total = F.col("total_records")

        def gauge(metric: str, column: str | None, value: Column) -> Column:
            return F.struct(
                F.lit(metric).alias("metric"),
                F.lit(column).cast("string").alias("column"),
                value.cast("double").alias("value"),
            )

        def share(part: str) -> Column:
            return F.coalesce(F.try_divide(F.col(part), total), F.lit(0.0))

        values = [gauge("null_ratio", c, share(f"n{i}")) for i, c in enumerate(df.columns)]
        values += [
            gauge("duplicate_ratio", None, share("duplicates")),
            gauge("active_records", None, total),
        ]
        frame = _totals(df).select(F.lit(layer).alias("layer"), F.inline(F.array(*values)))
        whole = frame if whole is None else whole.unionByName(frame)
    return whole
