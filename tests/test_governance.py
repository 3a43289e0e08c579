import pytest
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.operators import governance as g
from helpers import at, rows


@pytest.fixture(scope="module")
def users(spark):
    return g.user_table(spark)


@pytest.fixture(scope="module")
def roles(spark):
    return g.role_table(spark)


def asked(spark, *pairs):
    return spark.createDataFrame([(u, a, "silver", at("2024-01-01 10:05:00")) for u, a in pairs], "user_id string, action string, resource string, timestamp timestamp")


def test_roles_and_permissions(spark, users, roles):
    known = asked(spark, ("admin", "read"), ("visitante_01", "read"), ("nobody", "read"), (None, "read"))
    assert set(rows(g.with_role(known, users), "user_id", "role")) == {
        ("admin", "admin"), ("visitante_01", "visitante"), ("nobody", ""), (None, ""),
    }
    lists = {r["user_id"]: r["permissions"] for r in g.with_permissions(known, users, roles).collect()}
    assert lists["admin"] == ["read", "write", "delete", "mask", "export"]
    assert lists["visitante_01"] == ["read"] and lists["nobody"] == []
    assert len(rows(g.grants(users, roles))) == sum(len(p) for p in fx.ROLE_PERMISSIONS.values())


@pytest.mark.parametrize(
    "user, action, allowed",
    [
        ("admin", "delete", True), ("analista_01", "read", True), ("analista_01", "write", True),
        ("analista_01", "delete", False), ("cientista_01", "export", True), ("cientista_01", "delete", False),
        ("visitante_01", "write", False), ("nobody", "read", False),
    ],
)
def test_decisions(spark, users, roles, user, action, allowed):
    assert g.authorize(asked(spark, (user, action)), users, roles).first()["authorized"] is allowed
    assert g.may(user, action) is allowed
    if allowed:
        g.demand(user, action)
    else:
        with pytest.raises(PermissionError):
            g.demand(user, action)


def test_audit(spark, users, roles, tmp_path):
    audit = g.audit_rows(asked(spark, ("admin", "read"), ("visitante_01", "delete"), ("visitante_01", "write")), users, roles)
    assert audit.columns == ["timestamp", "user_id", "role", "action", "resource", "authorized"]
    path = g.append_audit(audit, str(tmp_path / "audit"))
    g.append_audit(audit, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    assert rows(g.denied_alerts(stored), "user_id", "denied", "window_start") == [("visitante_01", 4, at("2024-01-01 10:00:00"))]
    assert g.denied_alerts(stored, at_least=5).count() == 0
    stamped = g.audit_rows(asked(spark, ("admin", "read")).drop("timestamp"), users, roles)
    assert stamped.first()["timestamp"] is not None


def test_layer_access(spark, users):
    layers = g.layer_table(spark)
    requests = spark.createDataFrame(
        [(u, layer) for u in ("admin", "analista_01", "visitante_01", "nobody") for layer in ("bronze", "silver", "gold")],
        "user_id string, layer string",
    )
    allowed = {(r["user_id"], r["layer"]) for r in g.layer_access(requests, users, layers).collect() if r["can_read"]}
    assert allowed == {
        ("admin", "bronze"), ("admin", "silver"), ("admin", "gold"), ("analista_01", "silver"), ("analista_01", "gold"),
        ("visitante_01", "gold"),
    }


def test_views(spark, people):
    assert g.masked_view(people, "admin", "k").first()["nome"] == "Ana Souza"
    for role in ("visitante", "analista", "unknown"):
        assert g.masked_view(people, role, "k").first()["nome"].startswith("A***_")
    scopes = spark.createDataFrame([("u", "PE"), ("u", "PE"), ("v", "RJ")], "user_id string, region string")
    assert set(rows(g.region_scope(people, scopes, "u"), "estado")) == {("PE",)}
    assert g.region_scope(people, scopes, "w").count() == 0


def test_sql_users_see_what_they_may(spark, people):
    me = F.current_user()
    granted = spark.range(1).select(me.alias("user_id"), F.lit("mask").alias("permission"))
    others = granted.withColumn("user_id", F.concat(me, F.lit("x"))).unionByName(granted.withColumn("permission", F.lit("read")))
    g.view_for_users(people, "clear_people", granted, "k")
    g.view_for_users(people, "masked_people", others, "k")
    assert rows(spark.sql("SELECT * FROM clear_people")) == rows(people)
    assert spark.table("masked_people").columns == people.columns
    assert rows(spark.sql("SELECT * FROM masked_people")) == rows(g.masked_view(people, "visitante", "k"))
    scopes = spark.range(1).select(me.alias("user_id"), F.lit("PE").alias("region"))
    g.view_for_users(people, "scoped_people", others, "k", scopes.union(scopes))
    assert rows(spark.sql("SELECT estado, nome LIKE 'A***_%' AS hidden FROM scoped_people")) == [("PE", True)] * 2
    g.view_for_users(people, "nobody", others, "k", scopes.where("false"))
    assert spark.table("nobody").isEmpty()
    g.view_for_users(people.drop("nome"), "narrow", others.where("false"), "k")
    assert "nome" not in spark.table("narrow").columns and spark.table("narrow").count() == 5
    joins = spark.sql("SELECT nome FROM masked_people")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in joins
