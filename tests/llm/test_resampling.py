"""Resampling by importance against brute force, and its CRC windows against zlib."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from carelake.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORDS.findall((text or "").encode().lower().decode())
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, targets, percent=5, least=20, buckets=10_000):
    made = [(doc, *plain_features(text)) for doc, text in rows]
    s = Counter(zlib.crc32(f.encode()) % buckets for _, _, fs in made for f in fs)
    t = Counter(zlib.crc32(f.encode()) % buckets for text in targets for f in plain_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc, n, fs in made:
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, n, len(fs), weight, score))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[: len(able) * percent // 100]
    ranks = {}
    for place, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(place)
    return sorted(((r[0], *r[2:], ranks[r].pop() if ranks.get(r) else None) for r in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def target_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_all_documents_equal_brute_force(spark, docs_of, texts):
    targets = [t for _, t in texts[:30]] + ["The ENDING of it", None, ""]
    assert got(resampling.resampled(docs_of(texts), target_of(spark, targets), percent=20)) == plain(texts, targets, percent=20)


def test_odd_rows(spark, docs_of):
    long = " ".join(f"w{i % 911}-x{i % 7}" for i in range(100_000))
    twenty = " ".join(f"Word{i}" for i in range(20))
    rows = [
        (1, None), (2, ""), (3, " \n\t--"), (4, twenty), (4, twenty), (None, twenty), (5, twenty.replace(" ", "  ")), (6, "É é€漢字 a1"),
        (7, long), (8, "x" * 5_000 + " b " + "y" * 70), (9, " ".join(["same"] * 30)), (10, "KK　z \x85q"),
    ]
    extra = docs_of(rows).selectExpr("*", "1 AS _id", "2 AS weight", "3 AS _row", "4 AS rank", "5 AS _rank")
    assert got(resampling.resampled(extra, target_of(spark, [twenty, "é"]), percent=60)) == plain(rows, [twenty, "é"], percent=60)
    assert got(resampling.resampled(docs_of([]), target_of(spark, ["a"]))) == []
    assert got(resampling.resampled(docs_of(rows), target_of(spark, []), percent=60)) == plain(rows, [], percent=60)


def test_pieces_and_groups_of_words_change_nothing(spark, docs_of, monkeypatch):
    rows = [(i, " ".join(f"w{i * j % 53}" for j in range(i))) for i in range(60)]
    monkeypatch.setattr(resampling, "PIECE", 40)
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", 25)
    words = resampling.Words()
    assert [n for part in words.numbers(rows[59][1]) for n in part] == [n for w in rows[59][1].split() for n in words.numbers(w).__next__()]
    assert got(resampling.resampled(docs_of(rows), target_of(spark, ["w1 w2"]))) == plain(rows, ["w1 w2"])


def test_crc_is_put_together_from_parts():
    parts = [(b"a" * n, b"qw\xff" * m) for n in (0, 1, 7) for m in (0, 1, 21, 22, 400)]
    crc = np.array([zlib.crc32(a) for a, _ in parts], np.uint32)
    moved = resampling.shifted(crc, np.array([len(b) for _, b in parts]))
    assert (moved ^ np.array([zlib.crc32(b) for _, b in parts], np.uint32)).tolist() == [zlib.crc32(a + b) for a, b in parts]
