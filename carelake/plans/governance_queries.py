"""Roles, decisions, audit and scoped views over access requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators import governance
from carelake.plans import inputs
from carelake.plans.batch_queries import _MASK_SQL
from carelake.plans.inputs import ENC_SQL, KEY, LAYERS_SQL, REQUEST_SQL, ROLES_SQL, USERS_SQL
from carelake.plans.registry import register


@register(
    "role_of_user",
    f"SELECT request_id, q.user_id, coalesce(role, '') AS role FROM ({REQUEST_SQL}) q LEFT JOIN {USERS_SQL} ON q.user_id = u.user_id",
)
def _(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir).select("request_id", "user_id")
    return governance.with_role(rows, governance.user_table(spark))


_DECIDED = (
    'SELECT q."timestamp", q.user_id, q.action, q.resource, q.request_id, coalesce(u.role, \'\') AS role, '
    "coalesce(r.permissions, []) AS permissions, coalesce(list_contains(r.permissions, q.action), false) AS authorized "
    f"FROM ({REQUEST_SQL}) q LEFT JOIN {USERS_SQL} ON q.user_id = u.user_id LEFT JOIN {ROLES_SQL} ON u.role = r.role"
)


@register(
    "permissions_of_user",
    f"SELECT user_id, role, array_to_string(permissions, ',') AS permissions, count(*) AS requests FROM ({_DECIDED}) GROUP BY 1, 2, 3",
)
def _(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir).select("user_id")
    granted = governance.with_permissions(rows, governance.user_table(spark), governance.role_table(spark))
    listed = granted.select("user_id", "role", F.array_join("permissions", ",").alias("permissions"))
    return listed.groupBy("user_id", "role", "permissions").agg(F.count(F.lit(1)).alias("requests"))


@register(
    "grants_used",
    "SELECT user_id, role, permission, uses FROM (SELECT u.user_id, u.role, unnest(r.permissions) AS permission "
    f"FROM {USERS_SQL} JOIN {ROLES_SQL} ON u.role = r.role) g JOIN (SELECT user_id AS who, action, count(*) AS uses "
    f"FROM ({REQUEST_SQL}) GROUP BY 1, 2) ON who = user_id AND action = permission",
)
def _(spark, sf_dir):
    granted = governance.grants(governance.user_table(spark), governance.role_table(spark))
    used = inputs.requests(spark, sf_dir).groupBy("user_id", F.col("action").alias("permission"))
    return used.agg(F.count(F.lit(1)).alias("uses")).join(granted, ["user_id", "permission"])


@register("authorize", f"SELECT request_id, user_id, role, action, authorized FROM ({_DECIDED})")
def _(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir).select("request_id", "user_id", "action")
    return governance.authorize(rows, governance.user_table(spark), governance.role_table(spark))


@register(
    "audit_table", f'SELECT "timestamp", user_id, role, action, resource, authorized FROM ({_DECIDED})'
)
def audit(spark, sf_dir):
    return governance.audit_rows(
        inputs.requests(spark, sf_dir), governance.user_table(spark), governance.role_table(spark)
    )


@register(
    "layer_access",
    "SELECT request_id, q.user_id, resource AS layer, coalesce(u.role, '') AS role, l.role IS NOT NULL AS can_read "
    f"FROM ({REQUEST_SQL}) q LEFT JOIN {USERS_SQL} ON q.user_id = u.user_id "
    f"LEFT JOIN {LAYERS_SQL} ON l.layer = q.resource AND l.role = u.role",
)
def _(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir).select("request_id", "user_id", F.col("resource").alias("layer"))
    return governance.layer_access(rows, governance.user_table(spark), governance.layer_table(spark))


def _register_view(role, masked):
    columns = ("patient_id", "cpf", "nome", "email", "telefone")
    shown = ", ".join(f"{_MASK_SQL[c]} AS {c}" if masked else c for c in columns)

    @register(f"masked_view_{role}", f"SELECT encounter_id, {shown} FROM ({ENC_SQL})")
    def _(spark, sf_dir):
        rows = inputs.encounters(spark, sf_dir).select("encounter_id", *columns)
        return governance.masked_view(rows, role, KEY)


_register_view("admin", masked=False)
_register_view("visitante", masked=True)


def _register_user_view(role, masked):
    """What a user of a role gets by SQL; the user who runs the query is given the role."""
    names = ("patient_id", "cpf", "nome", "email", "telefone")
    shown = ", ".join(f"{_MASK_SQL[c]} AS {c}" if masked else c for c in names)

    @register(f"sql_view_{role}", f"SELECT encounter_id, {shown}, estado, heart_rate FROM ({ENC_SQL})")
    def _(spark, sf_dir):
        allowed = governance.role_table(spark).where(F.col("role") == role)
        granted = allowed.select(F.current_user().alias("user_id"), F.explode("permissions").alias("permission"))
        governance.view_for_users(inputs.encounters(spark, sf_dir), f"encounters_{role}", granted, KEY)
        return spark.sql(f"SELECT encounter_id, {', '.join(names)}, estado, heart_rate FROM encounters_{role}")


_register_user_view("admin", masked=False)
_register_user_view("visitante", masked=True)


@register(
    "region_scope",
    "SELECT e.encounter_id, e.estado FROM "
    f"({ENC_SQL}) e WHERE estado IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')",
)
def _(spark, sf_dir):
    states = inputs.state_reference(spark, sf_dir)
    scopes = states.select(F.col("regiao").alias("user_id"), F.col("sigla").alias("region"))
    rows = inputs.encounters(spark, sf_dir).select("encounter_id", "estado")
    return governance.region_scope(rows, scopes, "ASIA")


@register(
    "denied_alerts",
    "SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS denied FROM "
    f"(SELECT date_trunc('hour', \"timestamp\") AS w, user_id FROM ({_DECIDED}) WHERE NOT authorized) GROUP BY w, user_id",
)
def _(spark, sf_dir):
    return governance.denied_alerts(audit(spark, sf_dir))
