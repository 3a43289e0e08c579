"""Sharding, exact deduplication and chat formatting: laws, brute force and odd rows."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle
from carelake.llm import chat, exact_dedup, sharding
from carelake.llm.queries import CHECKS, QUERIES
from carelake.session import fresh_path

ODD = [(1, None), (1, None), (2, ""), (3, "a"), (None, "a"), (None, None), (4, "é" * 70_000), (5, "a"), (5, "a"), (5, "b")]


@pytest.mark.parametrize("name", ["op3_shards", "op7_exact_dedup", "op9_chat_format"])
def test_query_equals_its_sql(spark, small, name):
    assert oracle.compare(QUERIES[name](spark, small), oracle.connect(small), CHECKS[name]) is None


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 100, 1009])
def test_permutation_and_its_inverse(spark, total):
    numbers = spark.range(total).select("id", sharding.permuted(F.col("id"), F.lit(total).cast("long"), 9).alias("to"))
    got = {r["id"]: r["to"] for r in numbers.collect()}
    assert got == {i: sharding.permuted_plain(i, total, 9) for i in range(total)}
    assert sorted(got.values()) == list(range(total))
    assert all(sharding.row_of(to % 16, to // 16, 16, total, 9) == i for i, to in got.items())


def test_shards_of_odd_rows(spark, docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 AS shard", "2 AS size", "3 AS row_number")
    got = sharding.document_shards(docs, 4, 1).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ODD
    )
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert got == sharding.document_shards(docs.repartition(5), 4, 1).collect() or Counter(got) == Counter(
        sharding.document_shards(docs.repartition(5), 4, 1).collect()
    )
    assert sharding.document_shards(docs_of([]), 4, 1).count() == 0
    path = fresh_path(spark, "shards")
    sharding.write_shards(docs_of(ODD), path, 4, 1, ["doc_id"])
    assert spark.read.parquet(path).count() == len(ODD)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("bits", [128, 4])
@pytest.mark.parametrize("most_hot, chunk", [(4096, 65_536), (1, 1), (20, 2)])
def test_exact_groups(docs_of, monkeypatch, keep, bits, most_hot, chunk):
    """A hash of four bits forces collisions, which the comparison of bytes has to tell apart. With
    4096, every repeated hash is hot, with 1 none, with 20 some."""
    monkeypatch.setattr(exact_dedup, "MOST_HOT", most_hot)
    monkeypatch.setattr(exact_dedup, "CHUNK", chunk)
    hashed = exact_dedup.content_hash
    if bits == 4:
        hashed = lambda text: F.substring(F.md5(text), 1, 1)
    rows = ODD + [(i, f"text {i % 40}") for i in range(100, 220)]
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep_id = (min(known) if keep == "smallest" else max(known)) if known else None
        kept_once = False
        for i in ids:
            kept = i == keep_id and not kept_once
            kept_once |= kept
            want[(i, keep_id, len(ids), kept, hashlib.sha256(t.encode()).hexdigest())] += 1
    docs = docs_of(rows).selectExpr("*", "1 AS keep_id", "2 AS kept")
    got = exact_dedup.classified(docs, keep=keep, hashed=hashed).collect()
    assert Counter(tuple(r) for r in got) == want


def test_hot_group_is_dealt_out(docs_of):
    docs = docs_of([(i, "hot") for i in range(3000)] + [(i, f"text {i // 2}") for i in range(3000, 9000)])
    keyed = exact_dedup._keyed(docs, "doc_id", "text", None, exact_dedup.content_hash)
    repeated = exact_dedup._repeated(keyed)
    assert [r["_hash"] for r in repeated.where("_hot").collect()] == [hashlib.md5(b"hot").digest()]
    dealt = exact_dedup._dealt(keyed, repeated, F.col("_id"))
    parts = {r["_salt"]: r["count"] for r in dealt.where("_text = 'hot'").groupBy("_salt").count().collect()}
    assert len(parts) == exact_dedup.SALTS and max(parts.values()) < 40
    assert dealt.where("_text <> 'hot' AND _salt <> 0").isEmpty()
    got = exact_dedup.classified(docs)
    assert got.where("group_size = 3000 AND keep_id = 0").count() == 3000
    assert got.where("group_size = 2").count() == 6000 and got.where("kept").count() == 3001


def test_kept_rows_have_all_columns(docs_of):
    docs = docs_of(ODD).selectExpr("*", "5 AS kept", "6 AS group_size", "7 AS _sha", "8 AS _id")
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {(r["kept"], r["_sha"], r["_id"]) for r in kept.collect()} == {(5, 7, 8)}
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect() if len(r["text"] or "") < 9) == [(1, ""), (3, "a"), (5, "b")]
    assert exact_dedup.classified(docs_of([])).count() == exact_dedup.deduplicated(docs_of([])).count() == 0


SAYINGS = ["</s>[INST] ok [/INST]", "a\\b\\\\c", "<|end|><|turn|>x<|text|>", "\\<", "<\\", "[[\\[", "", "$1 \\1", "é🙂\n\n", "x" * 50_000]


def test_turns_come_back(spark):
    rows = [(i, n, role, text) for i in range(3) for n, (role, text) in enumerate(zip(["user", "assistant", "<|end|>\\", None, ""] * 2, SAYINGS))]
    rows += [(None, 0, "user", "lost"), (7, 1, "assistant", None), (7, None, None, None), (7, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS turns", "2 AS formatted")
    out = chat.formatted(chat.canonical(df)).select("conv_id", "turns", "segments", "formatted", chat.parsed(F.col("formatted")).alias("back"), chat.learned(F.col("segments")).alias("learned"))
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == {0, 1, 2, 7, None}
    for key, r in got.items():
        mine = sorted(((n is not None, n, role or "", text or "") for c, n, role, text in rows if c == key), key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(m[2], m[3]) for m in mine]
        assert r["back"] == r["turns"]
        assert r["learned"] == "".join(m[3] for m in mine if m[2] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count("<|end|>") == len(mine) and "[INST]" not in r["formatted"]
    assert chat.canonical(df.where("false")).count() == 0


def test_layouts_of_records(spark):
    records = {
        "messages": '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":null}],"id":5}',
        "conversations": '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        "turns": '{"turns":[{"role":"user","text":"q"}]}',
        "prompt_completion": '{"prompt":"q","completion":"a","score":1.5}',
        "prompt_response": '{"prompt":"q","response":"a"}',
        "instruction": '{"instruction":"q","output":"a"}',
        "instruction_input": '{"instruction":"q","input":"i","output":"a"}',
        "system_prompt": '{"system":"s","prompt":"q","response":"a"}',
        "unmapped": '{"question":"q"}',
    }
    rows = [*records.items(), ("broken", "{"), ("none", None)]
    got = {r["key"]: r for r in chat.canonical_json(spark.createDataFrame(rows, "key string, record string"), "key", "record").collect()}
    assert len(got) == len(rows)
    assert all(got[k]["layout"] == k for k in records)
    assert got["broken"]["layout"] == got["none"]["layout"] == "unmapped" and got["none"]["turns"] is None
    said = {k: [(t["role"], t["text"]) for t in r["turns"]] for k, r in got.items() if r["turns"] is not None}
    assert said["messages"] == [("user", "q"), ("assistant", "")]
    assert said["conversations"] == said["prompt_completion"] == said["instruction"] == [("user", "q"), ("assistant", "a")]
    assert said["instruction_input"] == [("user", "q"), ("user", "i"), ("assistant", "a")]
    assert said["system_prompt"][0] == ("system", "s")


def test_null_fields_and_all_elements_select_layouts(spark):
    records = {
        "prompt_response": ('{"prompt":"q","response":null}', [("user", "q")]),
        "messages": ('{"messages":[{"role":"user","content":null},{"role":"assistant","content":"a"}]}', [("user", ""), ("assistant", "a")]),
        "turns": ('{"turns":[{"role":"user"},{"text":"a"}],"prompt":"p","output":1}', [("user", ""), ("", "a")]),
        "instruction_input": ('{"instruction":"q","input":null,"output":"a","system":"s"}', [("user", "q"), ("assistant", "a")]),
    }
    df = spark.createDataFrame([(k, r) for k, (r, _) in records.items()], "key string, record string")
    for r in chat.canonical_json(df, "key", "record").collect():
        assert (r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) == (r["key"], records[r["key"]][1])


def test_further_columns_do_not_matter(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id int, turn int, role string, text string")
    want = [tuple(r) for r in chat.canonical(rows).collect()]
    more = rows.selectExpr("*", *(f"'x' AS {n}" for n in ("system", "prompt", "response", "input", "output", "instruction")))
    assert [tuple(r) for r in chat.canonical(more).collect()] == want and want[0][1] == "turn_rows"
    pairs = spark.createDataFrame([(1, "q", "a", "o")], "conv_id int, prompt string, response string, output string")
    assert chat.canonical(pairs).first()["layout"] == "prompt_response"


def test_unknown_schema_is_refused(spark):
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical(spark.range(1).selectExpr("id AS conv_id", "'x' AS question"))


def test_equal_paths_share_a_fingerprint(spark):
    rows = [
        ("a", '{"prompt": "x", "response": null}'), ("b", '{"response": "y", "prompt": null}'), ("c", '{"prompt": 1, "response": [], "more": {"k": 2}}'),
        ("d", '{"messages": [{"role": "user"}, {"content": "t"}]}'), ("e", '{"messages": [{"content": null, "role": 1}]}'), ("f", "[1]"), ("g", None),
    ]
    got = {r["key"]: r["layout"] for r in chat.canonical_json(spark.createDataFrame(rows, "key string, record string"), "key", "record").collect()}
    assert got == {"a": "prompt_response", "b": "prompt_response", "c": "prompt_response", "d": "messages", "e": "messages", "f": "unmapped", "g": "unmapped"}
    typed = spark.range(1).selectExpr("'x' AS response", "'y' AS prompt").schema
    other = spark.range(1).selectExpr("1 AS prompt", "2 AS response").schema
    assert chat.schema_fingerprint(typed) == chat.schema_fingerprint(other)
    one = spark.createDataFrame([(["response", "prompt", "prompt"],)], "p array<string>")
    assert one.select(chat.fingerprint(F.col("p"))).first()[0] == chat.schema_fingerprint(typed)
    assert chat.schema_fingerprint(typed) != chat.schema_fingerprint(spark.range(1).selectExpr("'x' AS response").schema)
    paths = spark.createDataFrame([("1", ["prompt", "response"]), ("1", ["prompt", "response"]), ("2", ["x"])], "_fingerprint string, _paths array<string>")
    assert sorted(tuple(r) for r in chat.mappings(paths).collect()) == [("1", "prompt_response"), ("2", "unmapped")]
