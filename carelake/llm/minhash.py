"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document's set holds the fingerprints of its distinct word shingles. Each of 64 hash functions keeps
16 bits of the smallest hash of the set; the distance of two signatures is the number of values that
differ. The signature is split into 16 chunks of 4 values. Two signatures that differ in 31 values or
fewer have, by the pigeonhole principle, a chunk with one error at most, so every chunk is entered
once for each value that may be the wrong one: 64 keys of three values each, of which any such pair
has one in common. All pairs under the distance are thus met; a pair of texts at a similarity of 0.8
exceeds the distance with a probability below 1e-7, more similar ones far more rarely.

Texts with the same words in the same order are one class from the start. Groups of classes that the
signatures connect are then judged on full sets, so every link is confirmed by counting common
shingles. Large buckets and large groups are dealt in parts: a first round joins what is linked
within each part; a second compares with all parts those that are not yet in the largest component of
their bucket or group. Pairs left out that way are connected already, so no link between components is
lost, no task holds more than two parts, and copies are never expanded into pairs.

Defined results: null and empty texts, and texts without words, have an empty set, are linked with
nothing and keep their own id; a text with fewer words than a shingle has one shingle, all its words;
null ids count last, a component without any other id is named null; repeated rows are linked with each
other, and each has a row in the result; an empty table gives an empty result. Texts of any length
are read in pieces. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import bits
from carelake.llm.common import stored
from carelake.llm.components import connected
from carelake.llm.fingerprints import PIECE, Words, cut, kinds

#: white space between words
KINDS = kinds(b" \t\n\x0b\x0c\r")
#: hash functions, values in a chunk, and the signature distance under which all pairs are met
VALUES, CHUNK = 64, 4
DISTANCE = 2 * (VALUES // CHUNK) - 1
#: hashes that are made at a time
HASHES = 16_384
#: rows and bytes of one part of a bucket or group
PART_ROWS, PART_BYTES = 1_024, 8_000_000
#: rows and bytes that are solved together when groups are small
BATCH_ROWS, BATCH_BYTES = 20_000, 16_000_000

_RANDOM = np.random.default_rng(0x3141)
_XOR = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_ODD = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)

Solver = Callable[[np.ndarray, list[bytes]], tuple[np.ndarray, np.ndarray]]


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest of each hash function's values over a set, which is not empty."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), HASHES):
        part = shingles[a : a + HASHES]
        least = np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _ODD[:, None]).min(axis=1))
    return ((least * _MIX) >> np.uint64(48)).astype("<u2")


def keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature (a row): one for each value that may be wrong, from the other values
    of its chunk and the place. Different values give different keys."""
    made = np.empty(signatures.shape, np.uint64)
    wide = signatures.astype(np.uint64)
    for place in range(VALUES):
        first = place - place % CHUNK
        key = np.full(len(signatures), place, np.uint64)
        for other in range(first, first + CHUNK):
            if other != place:
                key = key << np.uint64(16) | wide[:, other]
        # an odd factor and a shift can be undone, so they keep keys apart
        key = key * _MIX
        made[:, place] = key ^ key >> np.uint64(32)
    return made


def _sets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[int, int, bytes | None, np.ndarray]]:
    """For the texts in column 1 of each batch: its number, the row, a digest of the words (None if
    there are none) and the set of shingles, sorted."""

    def shingles(words: Words, first: int, last: int, known: int) -> np.ndarray:
        """Of the words from first to last, those shingles that end behind the known ones."""
        at = np.arange(first + max(0, known - length + 1), last - length + 1)
        return words.prints(at, length, np.uint64(0))

    def whole(words: Words, first: int, last: int) -> bytes:
        return words.data[words.start[first] : words.start[last - 1] + words.size[last - 1]].tobytes()

    def together(number: int, rows: list[int], texts: list[bytes]):
        words = Words(b"\n".join(texts), KINDS)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        edge = np.searchsorted(words.at, begin)
        for row, a, b in zip(rows, edge[:-1].tolist(), edge[1:].tolist()):
            if a == b:
                yield number, row, None, np.empty(0, np.uint64)
                continue
            own = shingles(words, a, b, 0) if b - a >= length else words.prints(np.array([a]), b - a, np.uint64(0))
            yield number, row, hashlib.blake2b(whole(words, a, b), digest_size=16).digest(), np.unique(own)

    def alone(number: int, row: int, text: bytes):
        digest, parts, count = hashlib.blake2b(digest_size=16), [], 0
        for part, known in cut(text, length, KINDS):
            words = Words(part, KINDS)
            n = len(words.start)
            if n > known:
                digest.update((b" " if count else b"") + whole(words, known, n))
                parts.append(np.unique(shingles(words, 0, n, known) if n >= length else np.empty(0, np.uint64)))
                count += n - known
        if 0 < count < length:
            words = Words(text, KINDS)
            parts = [words.prints(np.array([0]), count, np.uint64(0))]
        yield number, row, digest.digest() if count else None, np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]))

    for number, batch in enumerate(batches):
        rows: list[int] = []
        texts: list[bytes] = []
        size = 0
        for row, value in enumerate(batch.column(1).cast(pa.binary())):
            text = value.as_py() or b""
            if len(text) > PIECE // 2:
                yield from alone(number, row, text)
                continue
            rows.append(row)
            texts.append(text)
            size += len(text) + 1
            if size > PIECE // 2:
                yield from together(number, rows, texts)
                rows, texts, size = [], [], 0
        if rows:
            yield from together(number, rows, texts)


def signed(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """_id, _digest (of the words in order), n_shingles and _signature of every row."""
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, digest, len(own), signature(own).tobytes() if len(own) else None) for _, row, digest, own in _sets(iter([batch]), length)]
            row, digest, size, signs = zip(*found) if found else ([], [], [], [])
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            columns = [ids, pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_digest", "n_shingles", "_signature"])

    kind = picked.schema["_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"_id {kind}, _digest binary, n_shingles bigint, _signature binary")


class Forest:
    """Components of numbered things; the smallest number is the root."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[at]
            if np.array_equal(up, at):
                return at
            at = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each member that is no root, and its root."""
        root = self.roots(np.arange(len(self.parent)))
        members = np.flatnonzero(root != np.arange(len(root)))
        return members, root[members]


def near_signatures(group: np.ndarray, payload: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all signatures of a group within the distance of each other."""
    signs = np.frombuffer(b"".join(payload), "<u2").reshape(-1, VALUES)
    forest = Forest(len(signs))

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.count_nonzero(signs[a] != signs[b], axis=1) <= DISTANCE

    bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(bounds, len(group)))
    at = np.arange(len(group))
    left, step = at[np.repeat(sizes <= 32, sizes)], 0
    # small groups all at once: neighbours, next neighbours and so on
    while len(left):
        step += 1
        left = left[left < len(group) - step]
        left = left[group[left] == group[left + step]]
        open_pairs = left[forest.roots(left) != forest.roots(left + step)]
        linked = open_pairs[near(open_pairs, open_pairs + step)]
        forest.join(linked, linked + step)
    for first, size in zip(bounds[sizes > 32].tolist(), sizes[sizes > 32].tolist()):
        own = at[first : first + size]
        rest = own
        while len(rest):
            # the first one that is in no component yet against all others of that kind
            linked = rest[1:][near(np.full(len(rest) - 1, rest[0]), rest[1:])]
            forest.join(np.full(len(linked), rest[0]), linked)
            rest = np.setdiff1d(rest[1:], linked, assume_unique=True)
        roots = forest.roots(own)
        main = np.bincount(roots - first).argmax() + first
        for one in own[roots != main].tolist():
            # whoever is outside the largest component against everything outside its own
            others = own[forest.roots(own) != forest.roots(np.array([one]))[0]]
            linked = others[near(np.full(len(others), one), others)]
            forest.join(np.full(len(linked), one), linked)
    return forest.links()


def similar_sets(percent: int) -> Solver:
    """Links that connect all sets of a group whose similarity is so many percent or more."""

    def solve(group: np.ndarray, payload: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sets = [np.frombuffer(p, "<u8") for p in payload]
        forest = Forest(len(sets))
        bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for first, last in zip(bounds.tolist(), [*bounds[1:].tolist(), len(group)]):
            size = np.array([len(s) for s in sets[first:last]])
            row = np.repeat(np.arange(last - first), size)
            _, column, count = np.unique(np.concatenate(sets[first:last]), return_inverse=True, return_counts=True)
            # shingles of one set alone are common to none
            shared = count[column] > 1
            row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            common = np.zeros((last - first, last - first))
            for a in range(0, int(column[-1]) + 1 if len(column) else 0, 2_048):
                part = slice(*np.searchsorted(column, [a, a + 2_048]))
                has = np.zeros((last - first, 2_048), np.float32)
                has[row[part], column[part] - a] = 1
                common += has @ has.T
            linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            a, b = np.nonzero(np.triu(linked, 1))
            forest.join(first + a, first + b)
        return forest.links()

    return solve


def _solved(groups: DataFrame, solver: Solver) -> DataFrame:
    """Links a, b within each group (`_key`, `_part`, `_turn`) of rows `_node`, `_payload`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(held: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            names = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            change = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in names]))
            return rows, np.cumsum(change)

        def links(rows: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
            node = rows.column(3).to_numpy(zero_copy_only=False)
            a, b = solver(group, rows.column(4).to_pylist())
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        rows_held = bytes_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows_held, bytes_held = rows_held + batch.num_rows, bytes_held + batch.nbytes
            if rows_held >= BATCH_ROWS or bytes_held >= BATCH_BYTES:
                rows, group = given(held)
                # the last group may go on in the next batch
                done = int(np.searchsorted(group, group[-1]))
                if done:
                    yield links(rows.slice(0, done), group[:done])
                held = [rows.slice(done)]
                rows_held, bytes_held = held[0].num_rows, held[0].nbytes
        if held:
            yield links(*given(held))

    # in order of the nodes, so that buckets with much in common name the same roots
    names = ["_key", "_part", "_turn"]
    dealt = groups.select(*names, "_node", "_payload").repartition(*names).sortWithinPartitions(*names, "_node")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def linked_within(rows: DataFrame, sizes: DataFrame, solver: Solver) -> DataFrame:
    """Links a, b that connect, within every `_key`, all rows (`_node`, `_payload`) that the solver
    links directly. `sizes`: `_key`, `_n`, `_bytes` of each key. `rows` are read once more where a key
    has more than one part."""
    weight = F.length("_payload")
    needed = F.greatest(F.ceil(F.col("_n") / PART_ROWS), F.ceil(F.col("_bytes") / PART_BYTES))
    crowded = stored(sizes.select("_key", needed.cast("int").alias("_parts")).where("_parts > 1"), "crowded")
    own_part = F.pmod(F.xxhash64("_node"), F.coalesce("_parts", F.lit(1))).cast("int")
    parted = rows.join(crowded, "_key", "left").withColumn("_part", own_part)
    first = stored(_solved(parted.withColumn("_turn", F.lit(0)), solver), "links")
    if crowded.isEmpty():
        return first
    # what is in no component with most of its bucket is compared with all parts of it
    roots = connected(first)
    named = rows.join(crowded, "_key").join(roots, F.col("_node") == roots["node"], "left")
    named = stored(named.select("_key", "_node", "_payload", "_parts", F.coalesce("root", "_node").alias("_root")), "named")
    by_root = named.groupBy("_key", "_root").agg(F.count(F.lit(1)).alias("_n"))
    main = by_root.groupBy("_key").agg(F.max(F.struct("_n", "_root"))["_root"].alias("_main"))
    rest = named.join(main, "_key").where("_root <> _main").drop("_root", "_main")
    left = rest.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_bytes"))
    turns = stored(left.select("_key", needed.cast("int").alias("_turns")), "turns")
    every = named.join(turns, "_key").withColumn("_part", F.pmod(F.xxhash64("_node"), F.col("_parts")).cast("int"))
    every = every.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)))
    asking = rest.join(turns, "_key").withColumn("_turn", F.pmod(F.xxhash64("_node"), F.col("_turns")).cast("int"))
    asking = asking.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    names = ["_key", "_part", "_turn", "_node", "_payload"]
    second = _solved(every.select(names).unionByName(asking.select(names)), solver)
    return first.unionByName(second)


def _bucketed(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`_key`, `_node`, `_payload`: every class in each bucket that it may share with others; and the
    sizes of the buckets that are shared."""

    def entered(mask):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = mask.value if mask is not None else None
            for batch in batches:
                for first in range(0, batch.num_rows, 1_000):
                    part = batch.slice(first, 1_000)
                    payload = part.column(1).to_pylist()
                    made = keys(np.frombuffer(b"".join(payload), "<u2").reshape(-1, VALUES))
                    if known is None:
                        yield pa.RecordBatch.from_arrays([pa.array(made.reshape(-1).view(np.int64))], names=["_key"])
                        continue
                    row, place = np.nonzero(bits.held(known, made))
                    columns = [pa.array(made[row, place].view(np.int64)), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))]
                    yield pa.RecordBatch.from_arrays(columns, names=["_key", "_node", "_payload"])

        return run

    signs = classes.select("_node", "_signature")
    every = signs.mapInArrow(entered(None), "_key bigint")
    counted = every.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = stored(counted.withColumn("_bytes", F.col("_n") * (2 * VALUES)), "shared")
    mask = classes.sparkSession.sparkContext.broadcast(bits.bit_map(shared, "_key"))
    return signs.mapInArrow(entered(mask), "_key bigint, _node bigint, _payload binary"), shared


def _full_sets(docs: DataFrame, wanted: DataFrame, length: int, text_col: str) -> DataFrame:
    """`_digest`, `_payload`: the set of every digest that is wanted, once for each."""
    first = F.conv(F.hex(F.substring("_digest", 1, 8)), 16, -10).cast("long")
    mask = docs.sparkSession.sparkContext.broadcast(bits.bit_map(wanted.select(first.alias("_first")), "_first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests, payload = [], []
            for _, _, digest, own in _sets(iter([batch]), length):
                if digest is None or digest in seen:
                    continue
                if bits.held(mask.value, np.frombuffer(digest[:8], ">u8").astype(np.uint64))[0]:
                    seen.add(digest)
                    digests.append(digest)
                    payload.append(own.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(payload, pa.binary())], names=["_digest", "_payload"])

    picked = docs.select(F.lit(0).alias("_none"), F.col(text_col).cast("string").alias("_text"))
    return picked.mapInArrow(run, "_digest binary, _payload binary")


def near_duplicates(
    docs: DataFrame, length: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: the id, n_shingles, component_id (the smallest id of its component)
    and kept, whether that is its own id. `percent` must be 80 or more, as the distance is made for."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    marked = stored(signed(docs, length, id_col, text_col), "signatures")
    by_words = marked.where("_digest IS NOT NULL").groupBy("_digest")
    classes = by_words.agg(F.min("_id").alias("_least"), F.first("_signature").alias("_signature"), F.first("n_shingles").alias("_n_shingles"))
    classes = stored(classes.withColumn("_node", F.monotonically_increasing_id()), "classes")
    near = connected(linked_within(*_bucketed(classes), near_signatures))
    grouped = stored(near.union(near.select("root", "root").distinct()), "groups")
    wanted = classes.join(grouped, F.col("_node") == F.col("node")).select("_digest", "_node", F.col("root").alias("_key"), "_n_shingles")
    wanted = stored(wanted, "wanted")
    sizes = wanted.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), (8 * F.sum("_n_shingles")).alias("_bytes"))
    sets = _full_sets(docs, wanted, length, text_col).groupBy("_digest").agg(F.first("_payload").alias("_payload"))
    rows = stored(wanted.join(sets, "_digest").select("_key", "_node", "_payload"), "sets")
    confirmed = connected(linked_within(rows, sizes, similar_sets(percent)))
    named = classes.join(confirmed, F.col("_node") == F.col("node"), "left")
    named = named.select("_digest", "_least", F.coalesce("root", "_node").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    component = named.join(least, "_root").select(F.col("_digest").alias("_words"), "component_id")
    out = marked.join(component, F.col("_digest") == F.col("_words"), "left")
    own = F.when(F.col("_digest").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(F.col("_id").alias(id_col), "n_shingles", own.alias("component_id"), F.col("_id").eqNullSafe(own).alias("kept"))
