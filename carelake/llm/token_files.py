"""Token ids in binary files of patched frame-of-reference blocks.

Documents are put in order of their id by a range shuffle, encoded with the tokenizers library, and
written as segments: binary values that hold whole documents, about `SEGMENT` ids each. A segment
holds blocks of `BLOCK` ids. Of each block the minimum is subtracted, the rest is packed at the width
that the `PERCENTILE` of its values needs, and wider values go to an exception list; an index says
where each block starts, so any range of ids is read without unpacking the others. Segments are rows
of a Parquet table, written and read by Spark, so they can lie in any store and lost tasks repeat
their own; each knows its place in its part of the table, and the sizes of the parts, one row for
each shuffle partition, say where the parts begin.

Layout of a segment, little-endian: magic, ids, blocks (4 bytes each); block starts (4 bytes each,
and the end); blocks of minimum (4), width (1), exceptions (2), packed values, exception places (2
each) and values (4 each).

Defined results: null counts as the empty text, which has only the end id; null ids come first;
rows of one id are in the order of their texts' hashes, and equal rows follow each other; a text
longer than a segment has a segment of its own; an empty table gives an empty one. Other columns are
not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import whole
from carelake.llm.words import WordCache

MAGIC = 0x31464650
BLOCK, SEGMENT, PERCENTILE = 256, 262_144, 90
CACHED_WORDS, CACHED_TOKENS = 600_000, 8_000_000
#: characters that Unicode versions agree on and that normal forms leave alone; others are left to the library
SETTLED = re.compile("[\t\n\r -~¡-įı-˿‐-⁞₠-₹]*")
#: the pre-tokenizer's pattern for these, a fixed value of the format
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼-¾]+|[\d²³¹¼-¾]|(?:[^\s\w]|_)+")

#: the letters that stand for bytes in the model's alphabet: printable ones for themselves, the others
#: for numbers from 256 on, in order
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _header(ids: int, starts: list[int]) -> bytes:
    return struct.pack("<III", MAGIC, ids, len(starts) - 1) + np.array(starts, "<u4").tobytes()


def _lanes(width: int) -> np.dtype:
    return np.dtype("<u2" if width <= 16 else "<u4")


def packed(ids: np.ndarray) -> bytes:
    """A segment of the ids (unsigned, below 2^32)."""
    count = len(ids)
    blocks = -(-count // BLOCK)
    values = np.zeros(blocks * BLOCK, np.int64)
    values[:count] = ids
    if count:
        values[count:] = ids[-1]
    values = values.reshape(blocks, BLOCK)
    least = values.min(axis=1, initial=np.iinfo(np.int64).max) if blocks else np.empty(0, np.int64)
    values = values - least[:, None]
    at = (BLOCK - 1) * PERCENTILE // 100
    wide = np.partition(values, at, axis=1)[:, at] if blocks else np.empty(0, np.int64)
    width = np.ceil(np.log2(wide + 1.0)).astype(np.int64)
    rows, places = np.nonzero(values >> width[:, None])
    outliers = values[rows, places]
    values[rows, places] = 0
    bits: dict[int, bytes] = {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        if not w:
            bits |= {int(b): b"" for b in own}
            continue
        lanes = _lanes(w)
        spread = np.unpackbits(values[own].astype(lanes).reshape(-1).view(np.uint8), bitorder="little")
        stream = np.packbits(spread.reshape(-1, 8 * lanes.itemsize)[:, :w].reshape(-1), bitorder="little").tobytes()
        size = w * BLOCK // 8
        bits |= {b: stream[size * i : size * (i + 1)] for i, b in enumerate(own.tolist())}
    first = np.searchsorted(rows, np.arange(blocks + 1))
    body, starts = [], [0]
    for b in range(blocks):
        lo, hi = first[b], first[b + 1]
        block = struct.pack("<IBH", int(least[b]), int(width[b]), int(hi - lo)) + bits[b]
        block += places[lo:hi].astype("<u2").tobytes() + outliers[lo:hi].astype("<u4").tobytes()
        body.append(block)
        starts.append(starts[-1] + len(block))
    return _header(count, starts) + b"".join(body)


def unpacked(segment: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids from start to stop of a segment; only their blocks are read."""
    magic, count, blocks = struct.unpack_from("<III", segment)
    if magic != MAGIC:
        raise ValueError("not a segment")
    stop = count if stop is None else min(stop, count)
    if start >= stop:
        return np.empty(0, np.uint32)
    starts = np.frombuffer(segment, "<u4", blocks + 1, 12).astype(np.int64) + 12 + 4 * (blocks + 1)
    chosen = range(start // BLOCK, (stop - 1) // BLOCK + 1)
    values = np.zeros((len(chosen), BLOCK), np.int64)
    by_width: dict[int, list[tuple[int, int]]] = {}
    later = []
    for row, b in enumerate(chosen):
        at = int(starts[b])
        least, width, outliers = struct.unpack_from("<IBH", segment, at)
        by_width.setdefault(width, []).append((row, at + 7))
        later.append((row, least, outliers, at + 7 + width * BLOCK // 8))
    for w, own in by_width.items():
        if w:
            size = w * BLOCK // 8
            stream = np.frombuffer(b"".join(segment[at : at + size] for _, at in own), np.uint8)
            lanes = _lanes(w)
            spread = np.zeros((len(own) * BLOCK, 8 * lanes.itemsize), np.uint8)
            spread[:, :w] = np.unpackbits(stream, bitorder="little").reshape(-1, w)
            values[[row for row, _ in own]] = np.packbits(spread.reshape(-1), bitorder="little").view(lanes).reshape(-1, BLOCK)
    for row, least, outliers, at in later:
        if outliers:
            values[row, np.frombuffer(segment, "<u2", outliers, at)] = np.frombuffer(segment, "<u4", outliers, at + 2 * outliers)
        values[row] += least
    flat = values.reshape(-1)
    offset = chosen[0] * BLOCK
    return flat[start - offset : stop - offset].astype(np.uint32)


class LibraryEncoder:
    """Encodes texts as the library does, each distinct word once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._words = WordCache(lambda fresh: self._inner.encode(self._pieces, fresh), CACHED_WORDS, CACHED_TOKENS)
        self._inner = WordCache(self._from_library, CACHED_WORDS, CACHED_TOKENS)

    def _from_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces by the library's model; what is marked by a space goes all its way."""
        tokens = self.library.model.tokenize
        made = [
            self.library.encode(word[1:], add_special_tokens=False).ids
            if word[0] == " "
            else [t.id for t in tokens(word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS))]
            for word in words
        ]
        count = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter((i for ids in made for i in ids), np.int64, int(count.sum())), count

    def _pieces(self, cache: WordCache, word: str) -> Iterator[int]:
        return iter([cache.spaced[word[1:]]]) if word[0] == " " else map(cache.plain.__getitem__, PIECES.findall(word))

    def _numbered(self, cache: WordCache, text: str) -> Iterator[int]:
        # no token goes over white space; a text the rules here do not settle is encoded as one word
        if SETTLED.fullmatch(text) and not any(a in text for a in self._added):
            return map(cache.plain.__getitem__, text.lower().split())
        return iter([cache.spaced[text]] if text else [])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._words.encode(self._numbered, texts)


@lru_cache(maxsize=1)
def library_encoder(path: str) -> LibraryEncoder:
    """One for each Python worker; the tasks are the parallel part."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryEncoder(path)


SEGMENTS = "part int, place bigint, n_ids bigint, content binary, ids array<bigint>, sizes array<bigint>"


def _segments(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(vocabulary)
        place = waiting = 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        sizes: list[int] = []

        def flush(part: int) -> pa.RecordBatch:
            nonlocal place, waiting
            ids = np.concatenate(held)
            row = [[part], [place], [len(ids)], [packed(ids)], [list(docs)], [list(sizes)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            place, waiting = place + len(ids), 0
            held.clear(), docs.clear(), sizes.clear()
            names = ["part", "place", "n_ids", "content", "ids", "sizes"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            for first in range(0, batch.num_rows, 500):
                rows = batch.slice(first, 500)
                token, count = coder.encode([t.as_py() for t in rows.column(1)])
                ends = np.cumsum(count)
                for doc, stop, size in zip(rows.column(0).to_pylist(), ends.tolist(), count.tolist()):
                    held.append(np.append(token[stop - size : stop], end_id))
                    docs.append(doc)
                    sizes.append(size + 1)
                    waiting += size + 1
                    if waiting >= SEGMENT:
                        yield flush(part)
        if docs:
            yield flush(part)

    return run


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the documents, in order of their ids, and writes them as a table of segments."""
    picked = docs.select(F.col(id_col).cast("bigint").alias("_id"), whole(text_col).alias("_text"))
    order = ["_id", F.xxhash64("_text")]
    ordered = picked.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_part", F.spark_partition_id()).mapInArrow(_segments(vocabulary, end_id), SEGMENTS).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The segments and `base`, the ids of all parts before."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    bases = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("base"))
    # one row for each shuffle partition of the writer
    return segments.join(F.broadcast(bases), "part")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, place, content, ids, sizes in zip(*(c for c in batch.columns)):
                token = unpacked(content.as_buffer().to_pybytes())
                count = np.array(sizes.as_py(), np.int64)
                ends = np.concatenate([[0], np.cumsum(count)])
                start = base.as_py() + place.as_py() + ends[:-1]
                listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(token.astype(np.int64)))
                names = ["doc_id", "start", "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(start), pa.array(count), listed], names=names)

    picked = _placed(spark, path).select("base", "place", "content", "ids", "sizes")
    return picked.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from what the segments hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, place, content, ids, sizes in zip(*(c for c in batch.columns)):
                token = unpacked(content.as_buffer().to_pybytes()).astype("<u4")
                count = np.array(sizes.as_py(), np.int64)
                ends = np.concatenate([[0], np.cumsum(count)])
                start = base.as_py() + place.as_py() + ends[:-1]
                crc = [zlib.crc32(token[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                columns = [ids.values, pa.array(start), pa.array(count), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    picked = _placed(spark, path).select("base", "place", "content", "ids", "sizes")
    return picked.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
