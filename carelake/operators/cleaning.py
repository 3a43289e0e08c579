"""Row selection, deduplication, union and enrichment of encounter records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import instant, ref, refs
from carelake.functions import masking, records, vitals

REQUIRED = ("patient_id", "timestamp")


def require(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Keep rows in which every named column is set."""
    return df.dropna(how="any", subset=list(columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row deduplication. Copies collapse in the map-side aggregate before the shuffle, so
    a row repeated a billion times costs one shuffled row per input task."""
    return df.distinct()


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*refs(keys)).distinct()


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    whole = first
    for other in others:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def with_event_instant(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Bring the event time to one type before a union: text is parsed, other types are cast."""
    kind = dict(df.dtypes).get(column)
    if kind is None or kind == "timestamp":
        return df
    parsed = records.event_instant(ref(column)) if kind == "string" else ref(column).cast("timestamp")
    return df.withColumn(column, parsed)


def clean(
    df: DataFrame,
    as_of=None,
    required: Sequence[str] = REQUIRED,
    counted: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Deduplicate, drop rows without the required columns, stamp the processing time.

    The null filter commutes with whole-row deduplication and goes first, so that it can reach
    the scan. ``counted`` takes two observations that receive ``rows`` before and after as part
    of the action that consumes the result; nothing is scanned twice to count. Read them with
    ``session.observed``, which also answers for inputs found to be empty.
    """
    if counted:
        df = df.observe(counted[0], F.count(F.lit(1)).alias("rows"))
    kept = distinct_rows(require(df, required))
    if counted:
        kept = kept.observe(counted[1], F.count(F.lit(1)).alias("rows"))
    return kept.withColumn("processing_time", instant(as_of))


def enrich(df: DataFrame) -> DataFrame:
    """Pressure sides and classes. Without a pressure column the frame passes unchanged; the
    heart-rate class and the fever flag additionally need their own input column."""
    present = set(df.columns)
    if "blood_pressure" not in present:
        return df
    sides = df.withColumns(
        {
            "sistolica": vitals.pressure_reading(F.col("blood_pressure"), 0),
            "diastolica": vitals.pressure_reading(F.col("blood_pressure"), 1),
        }
    )
    classes: dict[str, Column] = {
        "categoria_pressao": vitals.pressure_class(F.col("sistolica"), F.col("diastolica"))
    }
    if "heart_rate" in present:
        classes["categoria_fc"] = vitals.heart_rate_class(F.col("heart_rate"))
    if "temperatura" in present:
        classes["febre"] = vitals.is_fever(F.col("temperatura"))
    return sides.withColumns(classes)


def mask_column(df: DataFrame, column: str, key: str, strict: bool = False) -> DataFrame:
    """Mask one column by the technique its name asks for; an absent column is no error."""
    if column not in df.columns:
        return df
    return df.withColumn(column, masking.mask_for(column, ref(column), key, strict))


def mask_sensitive(
    df: DataFrame, key: str, fields: Sequence[str] = fx.SENSITIVE_FIELDS, strict: bool = False
) -> DataFrame:
    """Mask every configured field the frame has, in one projection."""
    present = [f for f in fields if f in df.columns]
    return df.withColumns({f: masking.mask_for(f, ref(f), key, strict) for f in present})


def add_record_metrics(df: DataFrame, as_of=None, event_column: str = "timestamp") -> DataFrame:
    """Processing lag in ms, then the JSON length of the record including that lag."""
    timed = df.withColumn("processing_lag_ms", records.lag_ms(instant(as_of), ref(event_column)))
    return timed.withColumn("record_size_bytes", records.json_length(*refs(timed.columns)))


def refine(df: DataFrame, key: str | None = None) -> DataFrame:
    """Enrich and, when a key is given, mask: every row by itself."""
    refined = df.transform(enrich)
    return refined if key is None else refined.transform(mask_sensitive, key)


def to_silver(
    df: DataFrame,
    key: str | None = None,
    as_of=None,
    required: Sequence[str] = REQUIRED,
    counted: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Clean, enrich and, when a key is given, mask."""
    return df.transform(clean, as_of, required, counted).transform(refine, key)
