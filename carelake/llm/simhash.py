"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint has a bit set where more than half of its shingle hashes have it.
Fingerprints at `max_bits` or fewer differing bits are linked, and linked documents form groups.

Equal fingerprints are collapsed first. Two fingerprints that differ in at most k bits agree on at
least three of k + 3 blocks, so each is sent to one bucket for every choice of three blocks; buckets
with more than `CROWD` members are split once more in the same way by pieces of their other bits,
which leaves at most a few thousand possible fingerprints in any bucket, however many documents
there are. Inside a bucket, the distances of every member to many reference fingerprints are
tabulated. Distances to a reference cannot differ by more than the distance of the two, so pairs
with a larger difference in any coordinate are discarded, and the bits of the others are compared.
A bucket gives a spanning forest of its links, never all its pairs.

Defined results: null counts as the empty text; texts of fewer words than a shingle have one shingle
of all their words; texts of no words have fingerprint 0 and are linked like any other; null ids do
not name a group unless it has no other; repeated rows are each returned; an empty table gives no
rows. Texts are read piece by piece, so a very long one needs no more memory than its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import plainly_named, stored, whole
from carelake.llm.components import connected

SEED = 42
#: members of a bucket from which it is split once more
CROWD = 4096
#: reference fingerprints: hashes of their numbers
PIVOTS = np.array([xxhash.xxh64_intdigest(f"pivot {i}") for i in range(32)], dtype=np.uint64)
_PIECE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words in lists, each from about a megabyte."""
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + _PIECE)
        end = gap.start() if gap else len(data)
        yield data[start:end].split()
        start = end


def shingle_hashes(data: bytes, length: int) -> Iterator[np.ndarray]:
    """Unsigned hashes of all shingles, repeats included."""
    kept: list[bytes] = []
    hashed = False
    for piece in word_pieces(data):
        words = kept + piece
        if len(words) < length:
            kept = words
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - length + 1].tolist()
        made = (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[length - 1 :].tolist()))
        yield np.fromiter(made, np.uint64, len(starts))
        hashed, kept = True, words[len(words) - length + 1 :]
    if kept and not hashed:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], np.uint64)


def fingerprint(text: str | None, length: int) -> int:
    counts, total = np.zeros(64, np.int64), 0
    # bytes.lower() changes A-Z alone
    for hashes in shingle_hashes((text or "").encode().lower(), length):
        for at in range(0, len(hashes), 65_536):
            part = hashes[at : at + 65_536]
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts += np.add.reduce(bits, axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * counts > total).view(">u8")[0])


def fingerprints(docs: DataFrame, length: int, text_col: str, carried: list[str]) -> DataFrame:
    """The carried columns and `_fp`, the fingerprint as a signed long."""
    picked = docs.select(*carried, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            made = np.fromiter((fingerprint(t.as_py(), length) for t in texts), np.uint64, len(texts))
            columns = [*batch.columns[:-1], pa.array(made.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_fp"])

    return picked.mapInArrow(run, f"{kinds}, _fp bigint")


def _masks(bits: list[int], pieces: int, agreeing: int) -> list[int]:
    """Masks of all choices of `agreeing` pieces of the given bits, as signed longs."""
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), pieces)]
    masks = [sum(choice) for choice in combinations(parts, agreeing)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _bucketed(prints: DataFrame, max_bits: int) -> DataFrame:
    """`_table`, `_key`, `_fp`: every fingerprint in each bucket that it shares with its neighbours."""
    masks = _masks(list(range(64)), max_bits + 3, 3)
    choices = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(m).cast("long").alias("m")) for i, m in enumerate(masks)))
    spread = prints.select("_fp", F.explode(choices).alias("_c")).select(
        F.col("_c.t").alias("_table"), F.col("_fp").bitwiseAND(F.col("_c.m")).alias("_key"), "_fp"
    )
    crowded = (
        spread.groupBy("_table", "_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWD).drop("_n")
    )
    marked = spread.join(crowded.withColumn("_crowded", F.lit(True)), ["_table", "_key"], "left")
    # finer masks for each table: its own bits, and most of the pieces of the others
    finer = []
    for i, m in enumerate(masks):
        rest = [b for b in range(64) if not (m >> b) & 1]
        finer.append([(1 + len(masks) + 1000 * i + j, m | s) for j, s in enumerate(_masks(rest, 8, 8 - max_bits))])
    by_table = F.array(
        *(F.array(*(F.struct(F.lit(t).alias("t"), F.lit(x).cast("long").alias("m")) for t, x in row)) for row in finer)
    )
    plain = marked.where("_crowded IS NULL").select("_table", "_key", "_fp")
    split = (
        marked.where("_crowded")
        .select("_fp", F.explode(F.get(by_table, F.col("_table"))).alias("_c"))
        .select(F.col("_c.t").alias("_table"), F.col("_fp").bitwiseAND(F.col("_c.m")).alias("_key"), "_fp")
    )
    return plain.unionByName(split)


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        up = parent[at]
        if np.array_equal(up, at):
            return at
        at = up


def bucket_links(prints: np.ndarray, bucket: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within buckets: member and root. Equal numbers in `bucket`, which
    is sorted, are one bucket."""
    table = np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    parent = np.arange(len(prints))
    left, step = np.arange(len(prints)), 0
    while True:
        step += 1
        left = left[left < len(prints) - step]
        left = left[bucket[left] == bucket[left + step]]
        if not len(left):
            break
        close = left
        for pivot in range(len(PIVOTS)):
            close = close[np.abs(table[close, pivot] - table[close + step, pivot]) <= max_bits]
        close = close[np.bitwise_count(prints[close] ^ prints[close + step]) <= max_bits]
        a, b = close, close + step
        while len(a):
            a, b = _roots(parent, a), _roots(parent, b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    root = _roots(parent, np.arange(len(prints)))
    linked = np.flatnonzero(root != np.arange(len(prints)))
    return prints[linked], prints[root[linked]]


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(table: np.ndarray, key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            edge = np.ones(len(prints), bool)
            edge[1:] = (table[1:] != table[:-1]) | (key[1:] != key[:-1])
            a, b = bucket_links(prints.view(np.uint64), np.cumsum(edge), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            # the last bucket may go on in the next batch
            whole_to = int(np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[-1:].sum() + 1)
            if whole_to > 1:
                yield solved(*(h[:whole_to] for h in held))
                held = [h[whole_to:] for h in held]
        if len(held[0]):
            yield solved(*held)

    return run


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs `a`, `b` of fingerprints that connect all linked ones. `prints`: `_fp`, each once."""
    buckets = _bucketed(prints, max_bits).repartition("_table", "_key").sortWithinPartitions("_table", "_key", "_fp")
    return buckets.mapInArrow(_links(max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    length: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row for each document: id, the carried columns, fingerprint (16 hexadecimal digits) and
    component_id, the smallest id of its group."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be from 0 to 5")
    marked = stored(fingerprints(docs, length, text_col, [id_col, *carried]), "fingerprints")
    prints = marked.groupBy("_fp").agg(F.min(id_col).alias("_least"))
    roots = connected(links(prints.select("_fp"), max_bits))
    groups = prints.join(roots, prints["_fp"] == roots["node"], "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root")
    )
    named = groups.groupBy("_root").agg(F.min("_least").alias("component_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    classes = groups.join(named.drop("_n"), "_root", "left").select(
        "_fp", F.when(F.col("component_id").isNull(), F.col("_least")).otherwise(F.col("component_id")).alias("component_id")
    )
    digits = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return marked.join(classes, "_fp").select(id_col, *carried, digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, length: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, one of each group: the one with the smallest id (null last), and among
    those the smallest hash of the text. All columns are kept."""
    docs, named, back = plainly_named(docs)
    id_col, text_col = named[id_col], named[text_col]
    signed = docs.withColumn("_sha", F.unhex(F.sha2(whole(text_col), 256)))
    groups = near_duplicates(signed, length, max_bits, id_col, text_col, ("_sha",))
    # a group is named by its smallest id; groups without any id by their fingerprints
    name = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("print"))
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_sha").alias("sha"))
    firsts = groups.select(name.alias("_name"), place.alias("_place")).groupBy("_name").agg(F.min("_place").alias("_first"))
    lost = groups.select(name.alias("_name"), place.alias("_place")).join(firsts, "_name").where("_place <> _first")
    lost = lost.select(F.col("_place.id").alias("_lost_id"), F.col("_place.sha").alias("_lost_sha")).distinct()
    same = signed[id_col].eqNullSafe(lost["_lost_id"]) & (signed["_sha"] == lost["_lost_sha"])
    rest = signed.join(lost, same, "left_anti")
    repeated = groups.groupBy(id_col, "_sha").count().where("count > 1").select(
        F.col(id_col).alias("_twice_id"), F.col("_sha").alias("_twice_sha")
    )
    if repeated.isEmpty():
        return rest.select(*back)
    again = signed[id_col].eqNullSafe(repeated["_twice_id"]) & (signed["_sha"] == repeated["_twice_sha"])
    once = rest.join(repeated, again, "left_semi").dropDuplicates([id_col, "_sha"])
    return rest.join(repeated, again, "left_anti").unionByName(once).select(*back)
