"""Role-based decisions over request tables.

Users and roles are tables. The joins carry no hints: they are broadcast while their size is
below the session threshold and shuffled beyond it, where AQE splits a user who makes a third of
all requests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.columns import ref, refs
from carelake.functions import masking
from carelake.operators import cleaning


def _table(spark: SparkSession, columns: Mapping[str, list]) -> DataFrame:
    """A driver-side table as a local relation. Unlike a frame made from a list of rows, its size
    is known to the optimizer, which therefore broadcasts it instead of shuffling the other side."""
    return spark.createDataFrame(pa.table(dict(columns)))


def user_table(spark: SparkSession, users: Mapping[str, str] = fx.USER_ROLES) -> DataFrame:
    return _table(spark, {"user_id": list(users), "role": list(users.values())})


def role_table(
    spark: SparkSession, roles: Mapping[str, Sequence[str]] = fx.ROLE_PERMISSIONS
) -> DataFrame:
    return _table(spark, {"role": list(roles), "permissions": [list(allowed) for allowed in roles.values()]})


def layer_table(spark: SparkSession, readers: Mapping[str, Sequence[str]] = fx.LAYER_READERS) -> DataFrame:
    pairs = [(layer, role) for layer, allowed in readers.items() for role in allowed]
    return _table(spark, {"layer": [p[0] for p in pairs], "role": [p[1] for p in pairs]})


def with_role(df: DataFrame, users: DataFrame) -> DataFrame:
    """Add the role of ``user_id``; an unknown user has the empty role."""
    known = users.select("user_id", "role")
    return df.join(known, "user_id", "left").withColumn("role", F.coalesce("role", F.lit("")))


def with_permissions(df: DataFrame, users: DataFrame, roles: DataFrame) -> DataFrame:
    """Add role and permission list; an unknown user has no permissions."""
    granted = users.join(roles, "role", "left").select("user_id", "role", "permissions")
    nothing = F.array().cast("array<string>")
    return df.join(granted, "user_id", "left").withColumns(
        {"role": F.coalesce("role", F.lit("")), "permissions": F.coalesce("permissions", nothing)}
    )


def grants(users: DataFrame, roles: DataFrame) -> DataFrame:
    """One row per user and permission."""
    return users.join(roles, "role").select("user_id", "role", F.explode("permissions").alias("permission"))


def authorize(requests: DataFrame, users: DataFrame, roles: DataFrame, action: str = "action") -> DataFrame:
    """Add ``authorized``: whether the user's role permits the requested action."""
    decided = with_permissions(requests, users, roles)
    allowed = F.coalesce(F.array_contains("permissions", ref(action)), F.lit(False))
    return decided.withColumn("authorized", allowed).drop("permissions")


def audit_rows(requests: DataFrame, users: DataFrame, roles: DataFrame, as_of=None) -> DataFrame:
    """The audit record of every request. A request without a timestamp of its own is stamped."""
    stamped = requests
    if "timestamp" not in requests.columns:
        stamped = requests.withColumn("timestamp", F.current_timestamp() if as_of is None else F.lit(as_of))
    return authorize(stamped, users, roles).select(
        "timestamp", "user_id", "role", "action", "resource", "authorized"
    )


def append_audit(audit: DataFrame, path: str) -> str:
    audit.write.mode("append").parquet(path)
    return path


def layer_access(requests: DataFrame, users: DataFrame, readers: DataFrame) -> DataFrame:
    """Add ``can_read``: whether the user's role may read the layer of the request."""
    allowed = readers.select("layer", "role").distinct().withColumn("__ok", F.lit(True))
    decided = with_role(requests, users).join(allowed, ["layer", "role"], "left")
    return decided.withColumn("can_read", F.coalesce("__ok", F.lit(False))).drop("__ok")


def may(user: str, permission: str) -> bool:
    """Single decision for guarding a driver-side step."""
    return permission in fx.ROLE_PERMISSIONS.get(fx.USER_ROLES.get(user, ""), ())


def demand(user: str, permission: str) -> None:
    if not may(user, permission):
        raise PermissionError(f"{user!r} may not {permission}")


def masked_view(df: DataFrame, role: str, key: str) -> DataFrame:
    """Personal fields in clear only for roles that hold the ``mask`` permission."""
    if "mask" in fx.ROLE_PERMISSIONS.get(role, ()):
        return df
    return cleaning.mask_sensitive(df, key)


def view_for_users(
    df: DataFrame,
    name: str,
    granted: DataFrame,
    key: str,
    scopes: DataFrame | None = None,
    region: str = "estado",
    fields: Sequence[str] = fx.SENSITIVE_FIELDS,
) -> None:
    """Register ``name`` for SQL users: who asks decides what is shown, when the query runs.

    Personal fields are in clear for users to whom ``granted(user_id, permission)`` gives ``mask``,
    masked for all others. With ``scopes(user_id, region)``, users see rows of their regions only.
    The permission is one value, looked up once for each query, so the rows are not joined for it; a
    query reads the columns that it names. A user who may explain queries sees the key in the plan:
    for such users, register the view over rows that are stored masked.
    """
    spark = df.sparkSession
    own = granted.where((F.col("user_id") == F.current_user()) & (F.col("permission") == "mask"))
    clear = own.agg((F.count(F.lit(1)) > 0).alias("clear")).scalar()
    masked = {f: masking.mask_for(f, ref(f), key) for f in fields if f in df.columns}
    shown = df.withColumns({f: F.when(clear, ref(f).cast("string")).otherwise(mask) for f, mask in masked.items()})
    if scopes is not None:
        regions = scopes.where(F.col("user_id") == F.current_user()).select(F.col("region").alias(region)).distinct()
        shown = shown.join(regions, region, "left_semi")
    shown.select(*refs(df.columns)).createOrReplaceTempView(name)


def region_scope(df: DataFrame, scopes: DataFrame, user: str, region: str = "estado") -> DataFrame:
    """Rows of the regions assigned to a user in ``scopes(user_id, region)``."""
    own = scopes.where(F.col("user_id") == user).select(F.col("region").alias(region)).distinct()
    return df.join(own, region, "left_semi")


def denied_alerts(audit: DataFrame, window: str = "1 hour", at_least: int = 1) -> DataFrame:
    """Refused requests per user and time window, from ``at_least`` on."""
    span: Column = F.window(F.col("timestamp"), window)
    refused = audit.where(~F.col("authorized"))
    counted = refused.groupBy(span.alias("w"), "user_id").agg(F.count(F.lit(1)).alias("denied"))
    return counted.where(F.col("denied") >= at_least).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", "denied"
    )
