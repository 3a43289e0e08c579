"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from carelake.llm import simhash
from carelake.llm.components import connected
from carelake.llm.queries import QUERIES


def plain_print(text, length=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def plain_groups(rows, bits=3):
    prints = [plain_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    as_array = np.array(prints, dtype=np.uint64)
    for i, p in enumerate(as_array):
        for j in np.flatnonzero(np.bitwise_count(as_array[:i] ^ p) <= bits):
            parent[find(i)] = find(int(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.get(find(i))
        least[find(i)] = doc if known is None else known if doc is None else min(doc, known)
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_query_equals_brute_force(spark, small, texts):
    assert got(QUERIES["op10_simhash"](spark, small)) == plain_groups(texts)


def test_edges(docs_of):
    long = " ".join(f"w{i % 977}" for i in range(300_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "ÀB c d e"), (8, "Àb C d e"),
        (9, long), (10, long + " end"), (9, long), (None, "alone words here now"), (None, None), (11, "x\x1cy z w v"),
    ]
    assert got(simhash.near_duplicates(docs_of(rows))) == plain_groups(rows)
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_pieces_do_not_change_the_hashes(monkeypatch):
    text = " ".join(random.Random(1).choices("a bb ccc dddd ee".split(), k=500)).encode()
    whole = np.concatenate(list(simhash.shingle_hashes(text, 3)))
    monkeypatch.setattr(simhash, "_PIECE", 7)
    assert np.array_equal(whole, np.concatenate(list(simhash.shingle_hashes(text, 3))))


@pytest.mark.parametrize("crowd", [4096, 3])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(60)}
    prints = np.array(sorted(prints | {rng.getrandbits(64) for _ in range(200)}), dtype=np.uint64)
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "_fp bigint")
    root = {r["node"]: r["root"] for r in connected(simhash.links(frame, 3)).collect()}
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            parent[find(i)] = find(int(j))
    signed = [int(p) for p in prints.view(np.int64)]
    mine, theirs = {}, {}
    for i, p in enumerate(signed):
        mine.setdefault(root.get(p, p), set()).add(p)
        theirs.setdefault(find(i), set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_one_of_each_keeps_all_columns(docs_of):
    same = " ".join(f"word{i}" for i in range(200))
    rows = [(5, same), (3, same + " more"), (3, same + " more"), (8, "quite other words in this text"), (None, same)]
    kept = simhash.one_of_each(docs_of(rows).selectExpr("*", "doc_id AS component_id", "text AS fingerprint", "1 AS _fp", "2 AS _sha"))
    assert sorted((r["doc_id"], r["component_id"]) for r in kept.collect()) == [(3, 3), (8, 8)]


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, **{1000 + i: 1000 for i in range(1, 50)}}
