"""MinHash near-duplicates against brute force over all pairs of sets."""

import random
import re

import numpy as np
import pytest

from carelake.llm import minhash


def plain_set(text, length=2):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < length:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}


def plain(rows, length=2, percent=80):
    sets = [plain_set(t, length) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.get(find(i))
        least[find(i)] = doc if known is None else known if doc is None else min(doc, known)
    out = [(doc, len(s), least[find(i)], least[find(i)] == doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_odd_rows_equal_brute_force(docs_of):
    rng = random.Random(2)
    long = [f"w{i * i % 99_991}" for i in range(200_000)]
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É b c d e"), (8, "é b c d e"), (9, "x\x1cy z"),
        (10, "one  two"), (11, "two one two one"), (11, "two one two one"), (12, "one two one two one"), (None, "alone words here now"), (None, None),
        (13, " ".join(long)), (14, edited(rng, long, 9_000)), (15, "b" * 1_200_000),
    ]
    frame = docs_of(rows).selectExpr("*", "1 AS _id", "2 AS _digest", "3 AS node", "4 AS component_id", "5 AS kept")
    for length in (2, 5):
        assert got(minhash.near_duplicates(frame, length)) == plain(rows, length)
    assert got(minhash.near_duplicates(docs_of([]), 2)) == []


@pytest.mark.parametrize("most", [1_024, 8])
def test_groups_around_the_bound_lose_no_link(docs_of, monkeypatch, most):
    # texts of one group lie on both sides of the bound, and parts hold few of them
    monkeypatch.setattr(minhash, "PART_ROWS", most)
    rng = random.Random(most)
    rows = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(60)]
        rows += [(len(rows) + i, edited(rng, base, rng.randint(0, 7))) for i in range(50)]
    rng.shuffle(rows)
    assert got(minhash.near_duplicates(docs_of(rows), 2)) == plain(rows)


def test_texts_equal_brute_force(docs_of, texts):
    assert got(minhash.near_duplicates(docs_of(texts), 5)) == plain(texts, 5)


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 16, minhash.VALUES).astype("<u2")
    for _ in range(300):
        b = a.copy()
        wrong = rng.choice(minhash.VALUES, minhash.DISTANCE, replace=False)
        b[wrong] ^= rng.integers(1, 1 << 16, len(wrong)).astype("<u2")
        both = minhash.keys(np.stack([a, b]))
        assert set(both[0].tolist()) & set(both[1].tolist())
        assert len(minhash.near_signatures(np.zeros(2), [a.tobytes(), b.tobytes()])[0]) == 1
    b[np.setdiff1d(np.arange(minhash.VALUES), wrong)[0]] ^= 1
    assert len(minhash.near_signatures(np.zeros(2), [a.tobytes(), b.tobytes()])[0]) == 0


def test_large_groups_are_solved_as_small_ones(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 1 << 16, (5, minhash.VALUES))
    rows = []
    for i in range(200):
        row = centres[i % 5].copy()
        wrong = rng.choice(minhash.VALUES, rng.integers(0, 40), replace=False)
        row[wrong] = rng.integers(0, 1 << 16, len(wrong))
        rows.append(row.astype("<u2"))
    signs = np.stack(rows)
    forest = minhash.Forest(200)
    for i in range(200):
        near = np.flatnonzero((signs[:i] != signs[i]).sum(axis=1) <= minhash.DISTANCE)
        forest.join(np.full(len(near), i), near)
    large = minhash.Forest(200)
    large.join(*minhash.near_signatures(np.zeros(200), [r.tobytes() for r in rows]))
    assert large.roots(np.arange(200)).tolist() == forest.roots(np.arange(200)).tolist()
