import json

import pytest

from carelake import schemas
from carelake.sources import feeds, readers, writers
from helpers import rows


def test_formats(spark, people, tmp_path):
    for fmt in readers.FORMATS:
        path = str(tmp_path / fmt)
        writer = people.write.option("header", True) if fmt == "csv" else people.write
        writer.format(fmt).save(path)
        again = readers.read_file(spark, path, fmt, schema=schemas.ENCOUNTER)
        assert rows(again) == rows(people)
    with pytest.raises(ValueError):
        readers.read_file(spark, "x", "orc")


def test_csv_inference_and_options(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("k;v\n1;2.5\n2;\n")
    df = readers.read_csv(spark, str(path), sep=";")
    assert df.dtypes == [("k", "int"), ("v", "double")] and rows(df) == [(1, 2.5), (2, None)]


def test_response_bodies(spark, tmp_path):
    path = tmp_path / "body.json"
    path.write_text(json.dumps([{"a": 1, "b": {"c": "x"}}, {"a": 2}], indent=2))
    df = readers.read_response(spark, str(path))
    assert rows(df.select("a", "b.c")) == [(1, "x"), (2, None)]


def test_pair_splits_records(spark, people, tmp_path):
    distinct = people.distinct()
    csv, js = writers.write_pair(distinct, str(tmp_path / "a.csv"), str(tmp_path / "b.jsonl"))
    left = readers.read_csv(spark, csv, schemas.ENCOUNTER)
    right = readers.read_json(spark, js, schemas.ENCOUNTER)
    assert rows(left.unionByName(right)) == rows(distinct)


# -- databases: the options handed to Spark; nothing is connected ------------------------------------


class Recorder:
    """Stands in for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **settings):
        self.told.update(settings)
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        self.told["loaded"] = True
        return self

    def save(self):
        self.told["saved"] = True

    def repartition(self, parts):
        self.told["parts"] = parts
        return self

    # as a session and as a frame
    @property
    def read(self):
        return self

    @property
    def write(self):
        return self

    def drop(self, *names):
        self.told["dropped"] = names
        return self


DB = {"url": "jdbc:postgresql://db/x", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}


def test_connection_options():
    env = {"JDBC_URL": "jdbc:postgresql://db/x", "DB_USER": "u", "DB_PASSWORD": "p"}
    assert readers.jdbc_options(env=env) == DB
    assert readers.jdbc_options(url="jdbc:other:x", driver="d", env=env)["url"] == "jdbc:other:x"
    with pytest.raises(ValueError):
        readers.jdbc_options(env={})


def test_query_goes_to_the_database():
    spark = Recorder()
    readers.read_query(spark, "SELECT 1", DB)
    assert spark.told["query"] == "SELECT 1" and spark.told["format"] == "jdbc" and spark.told["loaded"]


def test_table_reads_are_split():
    spark = Recorder()
    readers.read_table(spark, "t", DB, "id", 1, 1000, 8)
    assert (spark.told["dbtable"], spark.told["partitionColumn"], spark.told["numPartitions"]) == ("t", "id", "8")


def test_append_and_refresh():
    frame = Recorder()
    writers.append_table(frame, "gold", DB)
    assert "numPartitions" not in frame.told and "parts" not in frame.told
    writers.append_table(frame, "gold", DB, connections=8)
    assert frame.told["parts"] == 8 and "numPartitions" not in frame.told
    assert frame.told["mode"] == "append" and frame.told["dbtable"] == "gold" and frame.told["saved"]
    spark = Recorder()
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    writers.refresh_table(spark, "gold", DB, DB, split=split, staging="gold_next")
    assert spark.told["numPartitions"] == "4" and spark.told["fetchsize"] == "10000" and spark.told["dbtable"] == "gold_next"
    assert spark.told["dropped"] == ("id", "created_at")
    assert spark.told["mode"] == "overwrite" and spark.told["truncate"] == "true"


def test_failing_tables_do_not_stop_the_others(spark):
    broken = {**DB, "driver": "no.such.Driver"}
    outcome = writers.refresh_tables(spark, ["a", "b"], broken, broken)
    assert list(outcome) == ["a", "b"] and all("no.such.Driver" in v for v in outcome.values())


# -- feeds -------------------------------------------------------------------------------------------


@pytest.fixture
def landed(tmp_path):
    def land(name, payload):
        path = tmp_path / f"{name}.json"
        path.write_text(payload if isinstance(payload, str) else json.dumps(payload, indent=1), encoding="utf-8")
        return str(path)

    return land


def test_states(spark, landed):
    path = landed("s", [{"id": 26, "sigla": "PE", "nome": "Pernambuco", "regiao": {"id": 2, "nome": "Nordeste"}}])
    assert rows(feeds.load_feed(spark, "estados_ibge", path)) == [(26, "PE", "Pernambuco", "Nordeste")]


def test_summary_defaults(spark, landed):
    path = landed("c", {"cases": 10, "casesPerOneMillion": 1.5, "updated": 1700000000123, "unused": [1]})
    got = feeds.load_feed(spark, "covid_brasil", path).first().asDict()
    assert got == {
        "pais": "Brazil", "casos_total": 10, "mortes_total": 0, "recuperados": 0, "ativos": 0, "casos_por_milhao": 1.5,
        "mortes_por_milhao": 0.0, "testes_total": 0, "populacao": 0, "data_atualizacao": "2023-11-14 22:13:20",
    }


def test_timeline(spark, landed):
    days = {"cases": {"1/1/21": 5, "1/2/21": 7}, "deaths": {"1/2/21": 1}, "recovered": {"1/9/21": 3}}
    path = landed("h", {"country": "Brazil", "timeline": days})
    assert rows(feeds.load_feed(spark, "covid_historico", path)) == [("1/1/21", 5, 0, 0), ("1/2/21", 7, 1, 0)]


def test_failing_feeds_are_empty(spark, landed, tmp_path):
    paths = {
        "estados_ibge": landed("broken", '[{"id": 1, '),
        "covid_brasil": str(tmp_path / "nowhere.json"),
        "covid_historico": landed("fine", {"timeline": {"cases": {"1/1/21": 5}}}),
    }
    loads = feeds.load_feeds(spark, paths)
    loaded = {name: load.rows for name, load in loads.items()}
    assert {name: df.count() for name, df in loaded.items()} == {
        "estados_ibge": 0, "covid_brasil": 0, "covid_historico": 1,
    }
    assert [(load.broken, load.failure is None) for load in loads.values()] == [(1, True), (0, False), (0, True)]
    assert feeds.load_feeds(spark, {})["estados_ibge"].rows.columns == ["estado_id", "sigla", "nome_estado", "regiao"]
    written = feeds.land_feeds(loaded, str(tmp_path / "bronze"))
    assert list(written) == ["covid_historico"] and written["covid_historico"].endswith("api_covid_historico.json")
    assert rows(spark.read.json(written["covid_historico"]), "data", "casos_acumulados") == [("1/1/21", 5)]


def test_a_broken_record_does_not_empty_a_feed(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    for i, body in enumerate(['{"country": "A", "cases": 1}', '{"country": "B", "ca', '{"country": "C", "cases": 3}']):
        (folder / f"{i}.json").write_text(body)
    load = feeds.read_feed(spark, "covid_brasil", str(folder))
    assert rows(load.rows, "pais", "casos_total") == [("A", 1), ("C", 3)]
    assert (load.broken, load.failure) == (1, None)
