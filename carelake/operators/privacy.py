"""Rights of the data subject: access, export, erasure, revocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.columns import before, ref
from carelake.functions import masking


def subject_rows(df: DataFrame, subject: str, key: str | None = None, column: str = "patient_id") -> DataFrame:
    """All rows of one subject. With a masking key the plain id is hashed first, as Silver holds
    only hashed ids; the comparison is with a constant and reaches the scan."""
    wanted = F.lit(subject) if key is None else masking.keyed_hash(F.lit(subject), key)
    return df.where(ref(column) == wanted)


def subjects_rows(df: DataFrame, subjects: DataFrame, column: str = "patient_id") -> DataFrame:
    """Rows of every listed subject, for answering many access requests in one job."""
    return df.join(subjects.select(ref(column)).distinct(), column, "left_semi")


def soft_delete(df: DataFrame, erasures: DataFrame, column: str = "patient_id") -> DataFrame:
    """Add ``is_deleted``: true for subjects on the erasure list."""
    listed = erasures.select(ref(column).alias("__subject")).dropna().distinct()
    listed = listed.withColumn("__listed", F.lit(True))
    flagged = df.join(listed, ref(column) == F.col("__subject"), "left")
    return flagged.withColumn("is_deleted", F.coalesce(F.col("__listed"), F.lit(False))).drop(
        "__subject", "__listed"
    )


def visible(df: DataFrame) -> DataFrame:
    """What readers see of a table with soft deletes."""
    return df.where(~F.col("is_deleted")).drop("is_deleted")


def purge(
    df: DataFrame,
    erasures: DataFrame,
    column: str = "patient_id",
    requested: str | None = None,
    retention_hours: float = 0,
    as_of=None,
) -> DataFrame:
    """Rows left after erasure requests older than the retention time have been carried out."""
    due = erasures
    if requested is not None:
        due = erasures.where(ref(requested) <= before(as_of, retention_hours))
    return df.join(due.select(ref(column)).dropna().distinct(), column, "left_anti")


def without_revoked(df: DataFrame, revocations: DataFrame, column: str = "patient_id") -> DataFrame:
    """Input for reprocessing without the subjects who revoked their consent."""
    return df.join(revocations.select(ref(column)).dropna().distinct(), column, "left_anti")


def export_subject(rows: DataFrame, path: str, fmt: str = "json", columns: Sequence[str] | None = None) -> str:
    """Portability export as JSON lines or CSV with header."""
    if fmt not in ("json", "csv"):
        raise ValueError(f"unsupported export format: {fmt}")
    chosen = rows if columns is None else rows.select(*[ref(c) for c in columns])
    writer = chosen.write.mode("overwrite")
    writer.csv(path, header=True) if fmt == "csv" else writer.json(path)
    return path
