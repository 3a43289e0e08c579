"""Byte-pair encoding and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelake.llm import bpe, token_files
from carelake.llm.queries import QUERIES
from carelake.llm.queries_tokens import END_ID, token_digests, vocabulary
from carelake.session import fresh_path

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
PARTS = [
    "a", "e", "th", "in", "IN", " ", "  ", "\n", "aaaa", "eeee", "1", "22", "'s", "'RE", "é", "É", "ß", "漢", "字", "🙂",
    "<|endoftext|>", "<|startoftext|>", "<|", "___", "=====", "-", "́", "՘", "\t", "\r\n", "\x85", "\xa0", " ",
    "Σ", "İ", "²", "¼", "ª", "\x1c", "\x00", "’",
]


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(BYTES)


def mixed(seed, n):
    rng = random.Random(seed)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 50))) for _ in range(n)]
    made += ["".join(rng.choices("abcdeno tin", k=150)) for _ in range(n // 10)]
    made += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x2FFF)])) for _ in range(40)) for _ in range(n // 5)]
    return [*made, "", " ", "\n", "word " * 20_000, "x" * 5000, "ab" * 700, "".join(rng.choices("etaoin", k=3000))]


def split(token, count):
    ends = np.concatenate([[0], np.cumsum(count)])
    return [token[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_ids_and_decoded_texts_equal_the_library(pairs):
    library, coder, texts = Tokenizer.from_file(BYTES), bpe.Encoder(pairs), mixed(1, 3000)
    mine = split(*coder.encode(texts))
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert mine == theirs
    assert [coder.decode(np.array(i, int)) for i in mine] == [library.decode(i, skip_special_tokens=False) for i in theirs]
    assert 0 < coder.words_merged < coder.words_encoded


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(pairs, text):
    library = Tokenizer.from_file(BYTES)
    assert split(*bpe.Encoder(pairs).encode([text])) == [library.encode(text, add_special_tokens=False).ids]


def test_boundary_test_equals_merging(pairs):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 50_000, (2, 4000))
    merged = [pairs.merged(pairs.bytes_of[a] + pairs.bytes_of[b]) == [a, b] for a, b in zip(x.tolist(), y.tolist())]
    assert pairs.compatible(x, y).tolist() == merged
    words = ["".join(random.Random(i).choices("aaabno", k=i % 40 + 1)).encode() for i in range(400)]
    assert pairs.merged_together(words) == [pairs.merged(w) for w in words]


def test_cache_that_starts_anew(pairs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    coder, texts = bpe.Encoder(pairs), mixed(2, 60)
    one_by_one = [split(*coder.encode([t]))[0] for t in texts]
    assert one_by_one == [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]


def test_bpe_rows(spark, docs_of):
    rows = [(1, None), (1, None), (2, ""), (3, "a b"), (None, "a b"), (4, "z " * 100_000)]
    got = token_digests(docs_of(rows).selectExpr("*", "1 AS ids", "text AS decoded"), BYTES).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(
        len(Tokenizer.from_file(BYTES).encode(t or "", add_special_tokens=False).ids) for _, t in rows
    )
    assert token_digests(docs_of([]), BYTES).count() == 0


def test_bpe_query(spark, small, texts):
    import hashlib

    library = Tokenizer.from_file(BYTES)
    want = set()
    for doc, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        want.add((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op5_bpe"](spark, small).collect()} == want


def test_library_encoder_equals_the_library():
    coder, texts = token_files.LibraryEncoder(WORDS), mixed(4, 3000)
    texts += [f"a{chr(i)}b 1{chr(i)}2 !{chr(i)}? {chr(i)}{chr(i)} x{chr(i)}" for i in range(0x2100)]
    assert split(*coder.encode(texts)) == [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1200), st.integers(0, 1200), st.integers(0, 1300))
def test_segments_give_their_ids_back(ids, start, stop):
    held = token_files.packed(np.array(ids, np.int64))
    assert token_files.unpacked(held).tolist() == ids
    assert token_files.unpacked(held, start, stop).tolist() == ids[start:stop]


def expected(rows):
    coder, start, want = token_files.LibraryEncoder(WORDS), 0, []
    for doc, text in rows:
        ids = [*coder.library.encode(text or "", add_special_tokens=False).ids, END_ID]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return want


def test_file_query(spark, small, texts):
    got = QUERIES["op8_token_files"](spark, small).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(sorted(texts))


def test_files_with_odd_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 50)
    rows = [(None, "b c"), (1, None), (2, ""), (3, "many words " * 5000), (4, "x"), (5, "same"), (5, "same")]
    path = fresh_path(spark, "odd")
    token_files.write(docs_of(rows).selectExpr("*", "1 AS part", "2 AS place"), path, WORDS, END_ID)
    got = token_files.checksums(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)
    whole = token_files.read(spark, path).where("doc_id = 4").first()
    assert len(whole["ids"]) == whole["n_tokens"] == 2
    path = fresh_path(spark, "none")
    token_files.write(docs_of([]), path, WORDS, END_ID)
    assert token_files.checksums(spark, path).count() == 0
