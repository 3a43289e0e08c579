"""The pipeline's stages against brute force, each on its own input."""

import hashlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from carelake.llm import quality
from carelake.llm.common import stored, table
from carelake.llm.queries_tokens import vocabulary
from test_mixing import plain_targets
from test_simhash import plain_groups


@pytest.fixture(scope="module")
def stages(spark, small):
    """Input and output rows of each stage."""
    docs, held = table(spark, small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, small), "stage")
        held.append((name, docs, out))
        docs = out
    return held


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages, small):
    columns = pq.read_schema(f"{small}/documents.parquet").names
    assert [name for name, _, _ in stages] == [n for n, _ in corpus_pipeline.STAGES]
    assert all(out.columns == columns for _, _, out in stages[:-1])


def test_quality_rules(stages):
    _, before, after = stages[0]
    judged = {r["doc_id"] for r in quality.judged(before, ["doc_id"]).where("kept").collect()}
    assert Counter(pairs(after)) == Counter(p for p in pairs(before) if p[0] in judged)
    assert 0.7 * before.count() < after.count() < before.count()


def test_exact_dedup(stages):
    _, before, after = stages[1]
    least = {}
    for doc, text in sorted(pairs(before), reverse=True):
        least[text] = doc
    assert Counter(pairs(after)) == Counter((doc, text) for text, doc in least.items())


def test_near_dedup(stages):
    _, before, after = stages[2]
    groups = plain_groups(pairs(before))
    assert sorted(d for d, _ in pairs(after)) == sorted({least for _, _, least in groups})


def test_mixing(stages):
    _, before, after = stages[3]
    size = lambda r: len(r["text"].split())
    have, took = Counter(), Counter()
    for r in before.collect():
        have[r["source"]] += size(r)
    times = Counter(r["doc_id"] for r in after.collect())
    for r in after.collect():
        took[r["source"]] += size(r)
    names = sorted(have)
    for name, target in zip(names, plain_targets([have[n] for n in names], [1 + i % 3 for i in range(len(names))], 3.0)):
        assert abs(took[name] - target) <= 0.15 * target
    assert max(times.values()) <= 3 and set(pairs(after)) <= set(pairs(before))


def test_encoding(stages):
    _, before, after = stages[4]
    library, want = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), Counter()
    for doc, text in pairs(before):
        ids = library.encode(text, add_special_tokens=False).ids
        want[(doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in after.collect()) == want


def test_run_gives_the_last_stage(spark, small, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, small).collect())) == Counter(map(tuple, stages[4][2].collect()))
