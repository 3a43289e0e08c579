"""Resampling of documents towards a target distribution by importance.

A pre-tokenizer that is not trained, a Regex Split of the tokenizers library over texts whose A-Z are
lowered, returns words with their offsets. Windows from the first offset of one word to the last of
another, one to three words, are the features; each falls into the bucket of its CRC-32. A window's
CRC is put together from its words' by the linear shift of the code, so whole batches are numpy
work, and stretches without a space are split once for each task. Histograms of buckets
over source and target give every bucket a gain, the sum of a document's gains is its weight, and
Gumbel noise from a hash of its id turns weights into a draw without replacement.

Defined results: null and empty texts have no words, no features and weight 0; they are never drawn.
Null ids hash as the empty string and come last among equal scores; rows that agree in score and id
come in a fixed order of the stored table, each with a rank of its own. An empty table gives an empty
result; an empty target gives gains from the source alone. Texts of any length are read in pieces.
Other columns are not read. Bytes that are not UTF-8 count as the replacement character.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import ranked, stored

#: a word of the contract, as the pre-tokenizer's pattern
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: characters of a text that are split at a time, words whose windows are made at a time
PIECE, WORDS_AT_ONCE = 1_000_000, 200_000
#: stretches that a task remembers, and the longest of them in characters
REMEMBERED, LONGEST = 300_000, 48
#: lengths in bytes whose shift is looked up in one table
SHORT = 64

_POLYNOMIAL = 0xEDB88320


def _apply(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The 32 columns of a matrix over bits, applied to each value."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


@lru_cache(maxsize=64)
def _zeros(power: int) -> np.ndarray:
    """The matrix that appends 2^power zero bytes to a CRC register."""
    if power == 0:
        values = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(8):
            values = (values >> np.uint32(1)) ^ np.where(values & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
        return values
    half = _zeros(power - 1)
    return _apply(half, half)


def _appended(crc: np.ndarray, length: int) -> np.ndarray:
    power = 0
    while length:
        if length & 1:
            crc = _apply(_zeros(power), crc)
        length, power = length >> 1, power + 1
    return crc


@lru_cache(maxsize=1)
def _short_tables() -> np.ndarray:
    """For each short length and each byte of a register, what the byte becomes."""
    bytes_at = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return np.stack([_appended(bytes_at.reshape(-1), n).reshape(4, 256) for n in range(SHORT)])


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved over so many bytes: crc(a + b) is shifted(crc(a), len(b)) ^ crc(b)."""
    tables = _short_tables()
    near = np.minimum(length, SHORT - 1)
    out = tables[near, 0, crc & 0xFF]
    for place in range(1, 4):
        out = out ^ tables[near, place, (crc >> np.uint32(8 * place)) & 0xFF]
    for n in np.unique(length[length >= SHORT]).tolist():
        own = np.flatnonzero(length == n)
        out[own] = _appended(crc[own], n)
    return out


def window_crcs(crc: np.ndarray, spaced: np.ndarray, length: np.ndarray, doc: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """CRC-32 and document of all windows of 1 to `most` words that stay within a document, joined by
    one space. `crc`, `spaced`: of each word alone, and followed by a space; `length`: in bytes."""
    open_crc, at = None, np.arange(len(crc))
    for n in range(1, most + 1):
        if n == 1:
            yield crc, doc
            open_crc = spaced
            continue
        last = at[n - 1 :]
        last = last[doc[last] == doc[last - n + 1]]
        # open_crc[i]: the n - 1 words that begin at i, and the space behind them
        front = open_crc[last - n + 1]
        yield shifted(front, length[last]) ^ crc[last], doc[last]
        longer = np.zeros(len(crc), np.uint32)
        longer[last - n + 1] = shifted(front, length[last] + 1) ^ spaced[last]
        open_crc = longer


class Words:
    """Words of texts as numbers, with CRC and length of each."""

    def __init__(self) -> None:
        from tokenizers import Regex, pre_tokenizers

        self._split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self._forget()

    def _forget(self) -> None:
        self._stretches: dict[str, tuple[int, ...]] = {}
        self._numbers: dict[str, int] = {}
        self._crc: list[int] = []
        self._spaced: list[int] = []
        self._length: list[int] = []

    def _number(self, word: str) -> int:
        known = self._numbers.get(word)
        if known is None:
            known = self._numbers[word] = len(self._crc)
            raw = word.encode()
            crc = zlib.crc32(raw)
            self._crc.append(crc)
            self._spaced.append(zlib.crc32(b" ", crc))
            self._length.append(len(raw))
        return known

    def _of(self, stretch: str) -> tuple[int, ...]:
        # a window begins and ends at offsets that the pre-tokenizer returns
        found = tuple(self._number(stretch[a:b]) for _, (a, b) in self._split.pre_tokenize_str(stretch))
        if len(stretch) <= LONGEST:
            self._stretches[stretch] = found
        return found

    def numbers(self, text: str) -> Iterator[list[int]]:
        """The text's words in order, in pieces cut at spaces."""
        known, start = self._stretches, 0
        while start < len(text):
            stop = text.find(" ", start + PIECE)
            stop = len(text) if stop < 0 else stop
            out: list[int] = []
            for stretch in text[start:stop].split(" "):
                if stretch:
                    found = known.get(stretch)
                    out += self._of(stretch) if found is None else found
            yield out
            start = stop + 1

    def columns(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC, CRC with a space behind, and length of numbered words."""
        crc, spaced = np.array(self._crc, np.uint32), np.array(self._spaced, np.uint32)
        return crc[numbers], spaced[numbers], np.array(self._length, np.int64)[numbers]

    def settle(self) -> None:
        """Starts anew once too much is remembered; numbers given before are void then."""
        if len(self._stretches) > REMEMBERED or len(self._numbers) > 2 * REMEMBERED:
            self._forget()


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Values between neighbouring bounds as one binary each."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


def _histograms(crcs: list[tuple[np.ndarray, np.ndarray]], docs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document-wise sorted buckets with their counts, and where each document's begin."""
    keys = np.concatenate([doc * buckets + crc % np.uint32(buckets) for crc, doc in crcs])
    keys, counts = np.unique(keys, return_counts=True)
    return keys % buckets, counts, np.searchsorted(keys, np.arange(docs + 1) * buckets)


def _featured(most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        names = ["_id", "n_words", "n_features", "places", "counts"]

        def made(ids: pa.Array, numbers: list[np.ndarray]) -> pa.RecordBatch:
            n = np.array([len(x) for x in numbers], np.int64)
            flat = np.concatenate([*numbers, np.empty(0, np.int64)])
            doc = np.repeat(np.arange(len(n)), n)
            places, counts, bounds = _histograms(list(window_crcs(*words.columns(flat), doc, most)), len(n), buckets)
            # differences to the bucket before pack better
            steps = np.diff(places, prepend=0)
            first = bounds[:-1][np.diff(bounds) > 0]
            steps[first] = places[first]
            features = sum(np.maximum(n - k, 0) for k in range(most))
            columns = [ids, pa.array(n), pa.array(features), _binary(steps.astype("<u4"), bounds), _binary(counts.astype("<u4"), bounds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            first, waiting, held = 0, 0, []
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                # bytes.lower() changes A-Z alone
                plain = (text.as_py() or b"").lower().decode(errors="replace")
                held.append(np.fromiter((i for piece in words.numbers(plain) for i in piece), np.int64))
                waiting += len(held[-1])
                if waiting >= WORDS_AT_ONCE:
                    yield made(batch.column(0).slice(first, len(held)), held)
                    words.settle()
                    first, waiting, held = row + 1, 0, []
            if held:
                yield made(batch.column(0).slice(first, len(held)), held)
                words.settle()

    return run


def features(docs: DataFrame, id_col: str, text_col: str, most: int, buckets: int) -> DataFrame:
    """_id, n_words, n_features and the histogram of each document's buckets, stored, and `_row`,
    which tells rows apart."""
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = picked.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_words bigint, n_features bigint, places binary, counts binary"
    made = picked.mapInArrow(_featured(most, buckets), schema)
    return stored(made.withColumn("_row", F.monotonically_increasing_id()), "features", compression="zstd")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, counts and documents of a batch of `places` and `counts`."""
    steps, counts, sizes = [], [], []
    for a, b in zip(batch.column("places"), batch.column("counts")):
        own = np.frombuffer(a.as_buffer(), "<u4").astype(np.int64)
        steps.append(np.cumsum(own))
        counts.append(np.frombuffer(b.as_buffer(), "<u4").astype(np.int64))
        sizes.append(len(own))
    none = np.empty(0, np.int64)
    return np.concatenate([*steps, none]), np.concatenate([*counts, none]), np.repeat(np.arange(len(sizes)), sizes)


def histogram(made: DataFrame, buckets: int) -> DataFrame:
    """bucket, n: features of all rows in each bucket that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 1_000):
                places, counts, _ = _unpacked(batch.slice(first, 1_000))
                np.add.at(total, places, counts)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = made.select("places", "counts").mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket, gain for every bucket, from the histograms of source and target."""
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(source.select("bucket", F.col("n").alias("_s")), "bucket", "left")
    both = both.join(target.select("bucket", F.col("n").alias("_t")), "bucket", "left").fillna(0, ["_s", "_t"])
    # one row each
    sums = both.agg(F.sum("_s").alias("_all_s"), F.sum("_t").alias("_all_t"))

    def number(name: str, more: int) -> Column:
        return (F.col(name) + more).cast("double")

    share = (number("_t", 1) * number("_all_s", buckets)) / (number("_s", 1) * number("_all_t", buckets))
    return both.join(F.broadcast(sums)).select("bucket", F.floor(F.lit(1000.0) * F.log(share)).alias("gain"))


def weighted(made: DataFrame, gain: DataFrame, buckets: int) -> DataFrame:
    """_id, _row, n_words, n_features and weight, the sum of the gains of a row's features."""
    table = np.zeros(buckets, np.int64)
    # as many rows as there are buckets
    for bucket, value in gain.collect():
        table[bucket] = value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1_000):
                part = batch.slice(first, 1_000)
                places, counts, row = _unpacked(part)
                weight = np.zeros(part.num_rows, np.int64)
                np.add.at(weight, row, table[places] * counts)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(weight)], names=["_id", "_row", "n_words", "n_features", "weight"])

    picked = made.select("_id", "_row", "n_words", "n_features", "places", "counts")
    kind = made.schema["_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"_id {kind}, _row bigint, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: Column, seed: int) -> Column:
    """1000 times a Gumbel number, rounded down, from a hash of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    most: int = 3,
    buckets: int = 10_000,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """One row for each document: the id, n_features, weight, score, and rank (from 1) among those
    drawn, null if not drawn. `percent` of the documents with `least_words` words or more are drawn."""
    made = features(docs, id_col, text_col, most, buckets)
    wanted = features(target.select(F.lit(0).alias("_id"), F.col(target_col).alias("_text")), "_id", "_text", most, buckets)
    gain = gains(histogram(made, buckets), histogram(wanted, buckets), buckets)
    scored = weighted(made, gain, buckets).withColumn("score", F.col("weight") + noise(F.col("_id"), seed))
    placed = scored.where(F.col("n_words") >= least_words).withColumn("_down", -F.col("score"))
    placed = ranked(placed.withColumn("_none", F.col("_id").isNull()), ["_down", "_none", "_id", "_row"], "_rank", "_total")
    drawn = F.when(F.col("_rank") < F.expr(f"_total * {int(percent)} div 100"), F.col("_rank") + 1)
    names = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    short = scored.where(F.col("n_words") < least_words)
    return placed.select(*names, drawn.alias("rank")).unionByName(short.select(*names, F.lit(None).cast("long").alias("rank")))
