"""Removal of repeated passages by suffix arrays.

A byte is removed if any string of `length` bytes that covers it also starts at another place of the
corpus. Places with the same string are brought together by anchors: of all grams of `GRAM` bytes in a
window of `length` bytes, the one with the smallest hash (the last, if several) depends on nothing but
the window's bytes, so equal windows have equal anchors. Every run of windows with one anchor is a
segment; only segments whose anchor occurs again are looked at further, and all segments of an anchor
meet in one task. There a suffix array of the segments' window starts is made in two stages: only
suffixes smaller than their successors are sorted directly, and all others are induced by one scan
over the buckets of first bytes, from suffixes already in place to the ones before them. Adjacent
common prefixes of `length` bytes or more are repeats.

Equal texts are looked at once; if there are several and they are long enough, all their bytes are
repeats. Anchors whose segments hold more than `CROWD` bytes do not go to one task: their windows are
hashed to 128 bits one by one and counted, with map-side counts, which is exact but for collisions
of that hash. Texts go through one shuffle, which both the segments and the removal read.

Defined results: null counts as the empty text; texts shorter than `length` lose nothing; matches
inside one text count, also where they overlap; strings are judged on the input; every row, repeated
or not, is returned with the result of its text; an empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import stored, whole

GRAM = 64
#: bytes of an anchor's segments from which its windows are counted instead of sorted
CROWD = 1_500_000
#: segment bytes sorted together
BATCH = 800_000
#: window starts handled at a time; places within must fit the low bits of a gram's hash
STRETCH, LOW = 1 << 19, np.uint64((1 << 20) - 1)

_RANDOM = np.random.default_rng(20)
_BYTES = [_RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) for _ in range(2)]
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)]


def _hashes(data: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """Polynomial hashes of all strings of the length, put together from powers of two."""
    power, size = _BYTES[kind][data], 1
    factor = _FACTORS[kind]
    out: np.ndarray | None = None
    done, rest = 0, length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out = power
                else:
                    n = len(data) - (done + size) + 1
                    out = out[:n] * factor + power[done : done + n]
                done += size
            rest >>= 1
            if rest:
                power = power[:-size] * factor + power[size:]
                factor, size = factor * factor, 2 * size
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Of all grams; `GRAM` is a power of two."""
    return _mixed(_hashes(data, GRAM))


def segments(data: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor's hash, first window, last window, anchors) of all runs of windows whose anchors have
    the same hash, in order."""
    span = length - GRAM + 1
    for start in range(0, len(data) - length + 1, STRETCH):
        piece = np.frombuffer(data, np.uint8, min(len(data) - start, STRETCH + length - 1), start)
        grams = gram_hashes(piece)
        # the smallest hash, and among equal ones the last place
        least, size = (grams & ~LOW) | (LOW - np.arange(len(grams), dtype=np.uint64)), 1
        while 2 * size <= span:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < span:
            least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
        anchor = grams[(LOW - (least & LOW)).astype(np.int64)]
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        run = first[np.concatenate([[True], anchor[first][1:] != anchor[first][:-1]])]
        anchors = np.diff(np.append(np.searchsorted(first, run), len(first)))
        last = np.append(run[1:], len(least)) - 1
        yield from zip(anchor[run].view(np.int64).tolist(), (run + start).tolist(), (last + start).tolist(), anchors.tolist())


def suffix_order(texts: list[bytes], owned: list[int], depth: int) -> tuple[bytes, np.ndarray]:
    """The texts one after the other, each with a byte for its end, and the starts of the first
    `owned` suffixes of every text, in the order of their first `depth` bytes; ends come first."""
    buffer = b"\0".join(texts) + b"\0"
    n = len(buffer)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)]) if len(texts) else np.empty(0, np.int64)
    ends = starts + sizes
    symbol = np.frombuffer(buffer, np.uint8).astype(np.int16) + 1
    symbol[ends] = 0
    # a suffix is smaller than its successor if the next different symbol is larger; ends are
    step = np.sign(np.diff(symbol, append=1)).astype(np.int8)
    step[ends] = 1
    decided = np.where(step != 0, np.arange(n), n - 1)
    rising = step[np.minimum.accumulate(decided[::-1])[::-1]] > 0
    # beside the owned starts, those up to the next rising one, from which the last ones are induced
    rises = np.flatnonzero(rising)
    own = np.asarray(owned, np.int64)
    upto = rises[np.searchsorted(rises, starts + own - 1)]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, upto + 1, -1)
    needed = np.cumsum(edge[:n]) > 0
    mine = np.zeros(n + 1, np.int64)
    np.add.at(mine, starts, 1)
    np.add.at(mine, starts + own, -1)
    mine = np.cumsum(mine[:n]) > 0
    # first stage: sort rising suffixes by their bytes
    seeds = np.flatnonzero(needed & rising)
    stop = np.minimum(seeds + depth, ends[np.searchsorted(ends, seeds)])
    keys = [buffer[a:b] for a, b in zip(seeds.tolist(), stop.tolist())]
    first = symbol[seeds]
    order = np.array(sorted(range(len(seeds)), key=keys.__getitem__), np.int64)
    seeds = seeds[order]
    # an end and a null byte differ as symbols only
    seeds = seeds[np.argsort(first[order], kind="stable")]
    bounds = np.searchsorted(symbol[seeds], np.arange(258))
    # second stage: scan the buckets in order; before a suffix in place lies one that is now known
    falling: list[list[np.ndarray]] = [[] for _ in range(257)]
    falls = needed & ~rising
    placed = []
    for c in range(257):
        front = np.concatenate(falling[c]) if falling[c] else np.empty(0, np.int64)
        parts = []
        while len(front):
            parts.append(front)
            front = front - 1
            front = front[front >= 0]
            front = front[falls[front] & (symbol[front] == c)]
        bucket = np.concatenate([*parts, seeds[bounds[c] : bounds[c + 1]]])
        if not len(bucket):
            continue
        placed.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[falls[before] & (symbol[before] > c)]
        if len(before):
            into = symbol[before]
            rank = np.argsort(into, kind="stable")
            before, into = before[rank], into[rank]
            cuts = np.flatnonzero(into[1:] != into[:-1]) + 1
            for part, bucket_of in zip(np.split(before, cuts), into[np.concatenate([[0], cuts])].tolist()):
                falling[bucket_of].append(part)
    in_order = np.concatenate(placed) if placed else np.empty(0, np.int64)
    return buffer, in_order[mine[in_order]]


def common_prefixes(buffer: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix has in common with the next one in order, `most` at most. Suffixes
    must have `most` bytes."""
    starts = order.tolist()
    same = np.fromiter((buffer[a : a + most] == buffer[b : b + most] for a, b in zip(starts, starts[1:])), bool, max(len(starts) - 1, 0))
    out = np.full(len(same), most, np.int64)
    at = np.flatnonzero(~same)
    left, right = order[:-1][at], order[1:][at]
    data = np.frombuffer(buffer, np.uint8)
    words = np.ndarray((max(len(data) - 7, 0),), "<u8", buffer, strides=(1,))
    depth = 0
    while len(at) and depth + 8 <= most:
        differ = words[left + depth] ^ words[right + depth]
        found = differ != 0
        # the lowest bit that differs is in the first byte that does
        low = differ[found] & (~differ[found] + np.uint64(1))
        out[at[found]] = depth + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        at, left, right = at[~found], left[~found], right[~found]
        depth += 8
    for d in range(depth, most):
        found = data[left + d] != data[right + d]
        out[at[found]] = d
        at, left, right = at[~found], left[~found], right[~found]
    return out


def repeated(texts: list[bytes], owned: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Of each text, the runs (first, last) of owned starts whose strings of the length start at
    another owned place too."""
    buffer, order = suffix_order(texts, owned, length)
    alike = common_prefixes(buffer, order, length) >= length
    flag = np.zeros(len(buffer) + 1, np.int8)
    flag[order[:-1][alike]] = 1
    flag[order[1:][alike]] = 1
    change = np.diff(flag, prepend=0)
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    of = np.searchsorted(starts, first, side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    # runs of neighbouring texts never touch: the end byte between them is not owned
    for t, a, b in zip(of.tolist(), first.tolist(), last.tolist()):
        out[t].append((a - int(starts[t]), b - int(starts[t])))
    return out


def _anchors(length: int):
    names = ["_text_id", "_anchor", "_from", "_to", "_anchors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                rows = batch.slice(first, 500)
                ids, found = [], []
                for text_id, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                    for segment in segments(text.as_py().encode(), length):
                        ids.append(text_id)
                        found.append(segment)
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                columns = [pa.array([s[i] for s in found], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), *columns], names=names)

    return run


def _cut(length: int):
    """Segments of each text with its runs of shared anchors."""
    names = ["_anchor", "_text_id", "_from", "_owned", "_segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_id, text, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
                data, runs = text.as_py().encode(), runs.as_py()
                columns = [
                    pa.array([r["_anchor"] for r in runs], pa.int64()),
                    pa.array([text_id.as_py()] * len(runs), pa.binary()),
                    pa.array([r["_from"] for r in runs], pa.int32()),
                    pa.array([r["_to"] - r["_from"] + 1 for r in runs], pa.int32()),
                    pa.array([data[r["_from"] : r["_to"] + length] for r in runs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _sorted_runs(length: int):
    """Repeats within the segments of each anchor; anchors come in order and whole."""
    names = ["_text_id", "_first", "_last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int, bytes]] = []
        size, last_anchor = 0, None

        def flush() -> pa.RecordBatch:
            found = repeated([h[3] for h in held], [h[2] for h in held], length)
            rows = [(h[0], h[1] + a, h[1] + b) for h, runs in zip(held, found) for a, b in runs]
            kinds = [pa.binary(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            anchors, ids, starts, owned, texts = (c.to_pylist() for c in batch.columns)
            for anchor, *row in zip(anchors, ids, starts, owned, texts):
                if anchor != last_anchor and size > BATCH:
                    yield flush()
                    held, size = [], 0
                last_anchor = anchor
                held.append(tuple(row))
                size += len(row[3])
        if held:
            yield flush()

    return run


def _hashed_windows(length: int):
    """Two hashes of every owned window of a segment."""
    names = ["_text_id", "_start", "_h1", "_h2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_id, start, owned, text in zip(*(c.to_pylist() for c in batch.columns[1:])):
                for at in range(0, owned, STRETCH):
                    data = np.frombuffer(text, np.uint8, min(STRETCH, owned - at) + length - 1, at)
                    made = [pa.array(_mixed(_hashes(data, length, kind)).view(np.int64)) for kind in (0, 1)]
                    places = pa.array(np.arange(len(made[0]), dtype=np.int32) + np.int32(start + at))
                    yield pa.RecordBatch.from_arrays([pa.array([text_id] * len(made[0]), pa.binary()), places, *made], names=names)

    return run


def spans_of(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the strings that start in the runs."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def _removed(length: int, keep: bool):
    names = ["_text_id", "spans", "n_removed", "n_spans", "kept_sha256", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_id, text, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                spans = spans_of([(r["_first"], r["_last"]) for r in runs.as_py()], length)
                at, kept = 0, []
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                row = [text_id.as_py(), [{"first": a, "stop": b} for a, b in spans], len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest if keep else None]
                kinds = [pa.binary(), pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())])), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    return run


SPANS = "array<struct<first:bigint,stop:bigint>>"


def without_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = False) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans, spans (first byte and the one
    after the last), kept_sha256 and, on request, kept_text, the remaining bytes."""
    if length < 2 * GRAM:
        raise ValueError(f"the length must be at least {2 * GRAM}")
    keyed = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text")).withColumn("_text_id", F.unhex(F.md5("_text")))
    long_enough = keyed.where(F.octet_length("_text") >= length)
    found = stored(long_enough.select("_text_id", "_text").mapInArrow(
        _anchors(length), "_text_id binary, _anchor bigint, _from int, _to int, _anchors int"
    ), "anchors")
    # equal texts have equal segments
    once = found.groupBy("_anchor", "_text_id", "_from").agg(F.max("_to").alias("_to"), F.max("_anchors").alias("_anchors"))
    sizes = once.groupBy("_anchor").agg(F.sum("_anchors").alias("_n"), F.sum(F.col("_to") - F.col("_from") + length).alias("_bytes"))
    shared = sizes.where("_n > 1").select("_anchor", (F.col("_bytes") > CROWD).alias("_crowded"))
    runs = once.join(shared, "_anchor").select("_text_id", F.struct("_anchor", "_from", "_to", "_crowded").alias("_run"))
    by_text = stored(runs.groupBy("_text_id").agg(F.collect_list("_run").alias("_runs")), "runs")
    first_of = long_enough.groupBy("_text_id").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_copies"))
    reps = stored(first_of, "text-ids")
    wanted = by_text.join(reps, "_text_id")
    # one shuffle of the texts serves both joins below
    texts = long_enough.withColumnRenamed("_text_id", "_of").select("_of", "_id", "_text")
    mine = (F.col("_of") == F.col("_text_id")) & F.col("_id").eqNullSafe(F.col("_rep"))
    both = texts.join(wanted, mine).select("_text_id", "_text", "_runs")
    crowd = F.filter("_runs", lambda r: r["_crowded"])
    calm = F.filter("_runs", lambda r: ~r["_crowded"])
    cut = "_anchor bigint, _text_id binary, _from int, _owned int, _segment binary"
    parts = both.select("_text_id", "_text", calm.alias("_runs")).mapInArrow(_cut(length), cut)
    sorted_parts = parts.repartition("_anchor").sortWithinPartitions("_anchor")
    repeats = sorted_parts.mapInArrow(_sorted_runs(length), "_text_id binary, _first int, _last int")
    if not by_text.where(F.exists("_runs", lambda r: r["_crowded"])).isEmpty():
        crowded = both.select("_text_id", "_text", crowd.alias("_runs")).mapInArrow(_cut(length), cut)
        windows = crowded.mapInArrow(_hashed_windows(length), "_text_id binary, _start int, _h1 bigint, _h2 bigint")
        windows = stored(windows, "windows")
        twice = windows.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        again = windows.join(twice, ["_h1", "_h2"], "left_semi")
        repeats = repeats.unionByName(again.select("_text_id", F.col("_start").alias("_first"), F.col("_start").alias("_last")))
    by_place = repeats.groupBy(F.col("_text_id").alias("_hit")).agg(F.collect_list(F.struct("_first", "_last")).alias("_repeats"))
    hits = texts.join(by_place.join(reps.where("_copies = 1"), F.col("_hit") == F.col("_text_id")), mine)
    kinds = f"_text_id binary, spans {SPANS}, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text binary"
    lost = hits.select("_text_id", "_text", "_repeats").mapInArrow(_removed(length, kept_text), kinds)
    keys = keyed.select(
        F.col("_id"),
        F.col("_text_id").alias("_key"),
        F.octet_length("_text").cast("bigint").alias("n_bytes"),
        F.sha2("_text", 256).alias("_sha"),
        *([F.col("_text").cast("binary").alias("_all")] if kept_text else []),
    )
    many = reps.where("_copies > 1").select(F.col("_text_id").alias("_several"))
    out = keys.join(lost, F.col("_key") == F.col("_text_id"), "left").join(many, F.col("_key") == F.col("_several"), "left")
    copy = F.col("_several").isNotNull()
    one = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_bytes").alias("stop")))
    return out.select(
        F.col("_id").alias(id_col),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, one).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit(b"")).otherwise(F.coalesce("kept_text", "_all")).alias("kept_text")] if kept_text else []),
    )
