"""Repeated passages against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from carelake.llm import suffix_dedup
from carelake.llm.queries import QUERIES


def plain(rows, length):
    """Digest of every row by a table of all strings of the length."""
    seen = defaultdict(int)
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for _, d in data:
        for i in range(len(d) - length + 1):
            seen[hash(d[i : i + length])] += 1
    out = []
    for doc, d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[hash(d[i : i + length])] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(d, covered) if not c)
        spans = sum(c and (i == 0 or not covered[i - 1]) for i, c in enumerate(covered))
        out.append((doc, len(d), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("alphabet, depth", [(2, 3), (3, 9), (26, 5), (256, 17)])
def test_suffix_order_and_common_prefixes(alphabet, depth):
    rng = random.Random(alphabet)
    for _ in range(60):
        texts = [bytes(rng.choices(range(alphabet), k=rng.randint(depth, 60))) for _ in range(rng.randint(1, 6))]
        texts += texts[: rng.randint(0, 1)]
        owned = [rng.randint(1, len(t) - depth + 1) for t in texts]
        buffer, order = suffix_dedup.suffix_order(texts, owned, depth)
        strings = [buffer[p : p + depth] for p in order.tolist()]
        assert strings == sorted(t[i : i + depth] for t, n in zip(texts, owned) for i in range(n))
        common = [next((i for i in range(depth) if a[i] != b[i]), depth) for a, b in zip(strings, strings[1:])]
        assert suffix_dedup.common_prefixes(buffer, order, depth).tolist() == common


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 300)
    rng = random.Random(3)
    shared = bytes(rng.choices(range(256), k=700))
    texts = [bytes(rng.choices(range(97, 100), k=rng.randint(0, 900))) + shared + b"ab" * rng.randint(0, 200) for _ in range(4)]
    by_window = defaultdict(set)
    for t in texts:
        runs = list(suffix_dedup.segments(t, 150))
        assert [r[1] for r in runs][0] == 0 and runs[-1][2] == len(t) - 150
        assert all(a[2] + 1 == b[1] for a, b in zip(runs, runs[1:]))
        for anchor, first, last, _ in runs:
            for i in range(first, last + 1):
                by_window[t[i : i + 150]].add(anchor)
    assert all(len(a) == 1 for a in by_window.values())


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéü漢", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(60), prose(300)
    rows = [(i, prose(rng.randint(0, 80)) + passage + prose(rng.randint(0, 80))) for i in range(12)]
    rows += [(20, long), (21, long), (21, long), (22, long[:500] + "x" + long[500:]), (23, "na " * 400), (24, "y" + "na " * 300)]
    rows += [(30, None), (31, ""), (32, "short"), (None, prose(90)), (None, long[-600:]), (40, passage + passage), (41, prose(150))]
    return rows


@pytest.mark.parametrize("crowd", [1_500_000, 1_000])
def test_planted_passages(spark, docs_of, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = planted(crowd)
    made = suffix_dedup.without_repeats(docs_of(rows).selectExpr("*", "1 AS n_bytes", "2 AS spans"), 150, kept_text=True)
    assert got(made) == plain(rows, 150)
    for r in made.collect():
        assert hashlib.sha256(bytes(r["kept_text"])).hexdigest() == r["kept_sha256"]
        assert sum(s["stop"] - s["first"] for s in r["spans"]) == r["n_removed"]


def test_no_rows(docs_of):
    assert got(suffix_dedup.without_repeats(docs_of([]))) == []


def test_query(spark, small, texts):
    assert got(QUERIES["op2_suffix_dedup"](spark, small)) == plain(texts, 400)
