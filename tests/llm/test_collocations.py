"""Phrase collocations against brute force in plain Python, with whole numbers of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from carelake.llm import bits, collocations, fingerprints

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain(rows, longest=3, least=10, top=2000, covered=50):
    found, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        total[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            found[lang].update(tuple(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    out = []
    for lang, f in found.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in able.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    around[p[i : i + n]] = max(around[p[i : i + n]], a)
        scored = []
        for p, a in able.items():
            if 100 * around[p] < covered * a:
                score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_odd_rows_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["The", "the", "of", "é", "É", "漢字", "a\x00b", "x" * 300, "w-1", "don't", "\x85", "q　q"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\x1c"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 80))), rng.choice(["en", None, "de", ""])) for i in range(120)]
    rows += [(500, None, "en"), (501, "", None), (502, "only few words", "fr"), (None, "new york city " * 40, "en"), (7, rows[7][1], "de"), (7, rows[7][1], "de")]
    # longer than a piece, without a delimiter
    rows.append((503, " ".join(f"w{i % 97} v{i % 89}" for i in range(200_000)), "long"))
    frame = spark.createDataFrame([(i, t, l, "s", 0) for i, t, l in rows], DOCS).selectExpr("*", "1 AS words", "2 AS phrase", "3 AS n", "4 AS f")
    assert got(collocations.collocations(frame)) == plain(rows)
    assert got(collocations.collocations(frame, longest=4, least=5, top=50, covered=80)) == plain(rows, 4, 5, 50, 80)
    assert got(collocations.collocations(frame.where("doc_id < 0"))) == []


def test_what_the_texts_contradict_is_counted_by_text(spark, monkeypatch):
    # with sums of another modulus no fingerprint agrees with its phrase
    monkeypatch.setattr(collocations, "CHECKS", 1_000_003)
    rows = [(i, f"deep blue sea {i % 7} and the old man, the old man and the sea" if i % 3 else None, "en") for i in range(90)]
    frame = spark.createDataFrame([(i, t, l, "s", 0) for i, t, l in rows], DOCS)
    assert got(collocations.collocations(frame)) == plain(rows)


def test_large_counts_stay_exact(spark):
    # a product of counts beyond 64 bits
    frame = spark.sql("SELECT 4000000000000L AS f, 3999999999999L AS l, 5000000000000L AS r")
    big = frame.selectExpr("cast(1000000 * cast(f AS decimal(15,0)) * cast(f AS decimal(15,0)) AS decimal(38,0)) div cast(cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)) AS decimal(38,0)) AS score")
    assert big.first()[0] == 1_000_000 * 4000000000000**2 // (3999999999999 * 5000000000000)


def test_texts_decide_where_fingerprints_collide():
    words = [b"aa", b"ab", b"aa", b"abcdefghi", b"abcdefghj", b"abcdefghi", b"b" * 40, b"b" * 39 + b"c", b"aa"]
    data = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    first, count = collocations.grouped(data, start, size, np.zeros(len(words), np.uint64), np.ones(len(words), np.int64))
    made = Counter()
    for at, n in zip(first, count):
        made[words[at]] += int(n)
    assert made == Counter(words)
    assert sum(count) == len(words)


def test_cut_texts_keep_all_runs(monkeypatch):
    monkeypatch.setattr(fingerprints, "PIECE", 50)
    rng = random.Random(3)
    text = "".join(rng.choice(["a", "bb", "ccc" * 30, "d"]) + rng.choice([" ", ". ", "\t", ", "]) for _ in range(400)).encode()
    whole, parts = Counter(), Counter()
    for counter, pieces in ((whole, [(text, 0)]), (parts, fingerprints.cut(text, 3, collocations.KINDS))):
        for raw, known in pieces:
            words = fingerprints.Words(raw, collocations.KINDS)
            for n in (1, 2, 3):
                counter.update(zip([n] * 10**6, words.prints(words.runs(n, known), n, np.uint64(7)).tolist()))
    assert whole == parts


def test_bit_map(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63, 5_000, dtype=np.int64)
    frame = spark.createDataFrame([(int(v),) for v in values[:2_500]], "h bigint")
    on = bits.bit_map(frame, "h", 20)
    assert bits.held(on, values[:2_500].view(np.uint64), 20).all()
    assert bits.held(on, values[2_500:].view(np.uint64), 20).mean() < 0.01
