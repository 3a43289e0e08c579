"""Frequent phrases of words and how strongly their words belong together, by Rabin-Karp fingerprints.

Texts are joined and read as bytes. Prefix sums of a polynomial over the bytes, in numpy, give the
fingerprint of any run of words from two places of the sums, so no phrase is spelled out to be
counted. Tasks count fingerprints, each with a pointer to one task that holds an occurrence and with
the sum of a second hash over all occurrences; a shuffle adds up counts and sums. A phrase of n words is
counted only where both phrases of n - 1 words within it may be frequent, by a bit map of frequent
fingerprints. The texts are then read once more, and the task that a frequent fingerprint points to
spells its phrase, once. The text decides whether all occurrences were this phrase: its second hash,
times the count, has to be the sum. Fingerprints that fail, because phrases collide or because the rows
were dealt differently the second time, are counted anew by text: there every occurrence is compared
byte by byte with the one it is grouped with, and counts are added up by phrase.

Defined results: null and empty texts have no words; a null language is the one given for it (`und`);
copies of rows count as often as they are there; phrases never go over a delimiter or the end of a
text; an empty table gives an empty result. Texts of any length are read in pieces. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import bits
from carelake.llm.common import stored
from carelake.llm.fingerprints import PIECE, Words, cut, gathered, kinds, same_text

#: white space, and delimiters that no phrase goes over
KINDS = kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: different fingerprints, and bytes of phrases, that a task holds before it gives them out
MOST_HELD, MOST_BYTES = 500_000, 16_000_000
#: sums of the second hash are kept modulo this, so that they can be added up without end
CHECKS = 1 << 31
#: rows of a language from which each of this many parts may bring its best
PARTS = 64

_TASK_MIX, _MIX = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=4096)
def _seed(lang: str) -> np.uint64:
    """What a language adds to its fingerprints."""
    import hashlib

    return np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little"))


def _pieces(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, Words, int]]:
    """Language, words, and how many of the first words were there before."""

    def joined(lang: str) -> tuple[str, Words, int]:
        texts = held.pop(lang)
        sizes.pop(lang)
        return lang, Words(b"\n".join(texts), KINDS), 0

    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = value.as_py() or b""
            if len(text) > PIECE // 2:
                for part, known in cut(text, longest, KINDS):
                    yield lang, Words(part, KINDS), known
                continue
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] > PIECE // 2:
                yield joined(lang)
            elif sum(sizes.values()) > 4 * PIECE:
                yield joined(max(sizes, key=sizes.get))
    for lang in list(held):
        yield joined(lang)


def _within(words: Words, n: int, at: np.ndarray, seed: np.uint64, frequent: np.ndarray | None) -> np.ndarray:
    """The runs of n words of which both runs of n - 1 words may be frequent."""
    if frequent is None or n < 2:
        return at
    for shift in (0, 1):
        at = at[bits.held(frequent, words.prints(at + shift, n - 1, seed))]
    return at


def counted_prints(docs: DataFrame, n: int, longest: int, frequent) -> DataFrame:
    """`print`, `n`, `check`, `part`: fingerprints of runs of n words, with counts and sums of
    the second hash, to be added up, and the task that they are in. Runs with a part that is not
    frequent, by the map broadcast as `frequent` if given, are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value if frequent is not None else None
        own_part = TaskContext.get().partitionId()

        def folded(prints: np.ndarray, counts: np.ndarray | None, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            order = np.argsort(prints)
            prints = prints[order]
            first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])[: len(prints)])
            if not len(first):
                return prints, np.empty(0, np.int64), np.empty(0, np.int64)
            count = np.diff(np.append(first, len(prints))) if counts is None else np.add.reduceat(counts[order], first)
            return prints[first], count, np.add.reduceat(checks[order], first) % CHECKS

        def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return folded(*(np.concatenate([h[i] for h in held]) for i in range(3)))

        def given(prints: np.ndarray, counts: np.ndarray, checks: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(prints), 65_536):
                part = slice(a, a + 65_536)
                columns = [pa.array(prints[part].view(np.int64)), pa.array(counts[part]), pa.array(checks[part])]
                columns.append(pa.array(np.full(len(columns[0]), own_part, np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=["print", "n", "check", "part"])

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0
        for lang, words, first in _pieces(batches, longest):
            at = _within(words, n, words.runs(n, first), _seed(lang), known)
            held.append(folded(words.prints(at, n, _seed(lang)), None, words.checks(at, n)))
            waiting += len(held[-1][0])
            if waiting > MOST_HELD:
                held = [summed()]
                waiting = len(held[0][0])
                if 2 * waiting > MOST_HELD:
                    yield from given(*held[0])
                    held, waiting = [], 0
        if waiting:
            yield from given(*summed())

    return docs.mapInArrow(run, "print bigint, n bigint, check bigint, part int")


def grouped(data: np.ndarray, start: np.ndarray, size: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place for each group of runs that are the same text, and the group's count. Runs of a
    fingerprint that differ from its first become groups of their own."""
    order = np.argsort(prints)
    edge = np.append(True, prints[order][1:] != prints[order][:-1])
    leader = order[np.flatnonzero(edge)][np.cumsum(edge) - 1]
    same = size[order] == size[leader]
    same[same] = same_text(data, start[order[same]], start[leader[same]], size[leader[same]])
    edge |= ~same
    own = np.where(same, leader, order)
    total = np.bincount(own, weights=counts[order], minlength=len(order)).astype(np.int64)
    first = order[edge]
    return first, total[first]


def _pointed(prints: np.ndarray, part: int) -> np.ndarray:
    """Hashes of fingerprints together with the task they point to."""
    made = (prints ^ np.uint64((part + 1) * int(_TASK_MIX) % (1 << 64))) * _MIX
    return made ^ made >> np.uint64(31)


def _pointers(often: DataFrame) -> DataFrame:
    """The same hashes of rows `print`, `part`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, part = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.uint64)
            made = (prints ^ (part + np.uint64(1)) * _TASK_MIX) * _MIX
            yield pa.RecordBatch.from_arrays([pa.array((made ^ made >> np.uint64(31)).view(np.int64))], names=["pointer"])

    return often.select("print", "part").mapInArrow(run, "pointer bigint")


def spelled_once(docs: DataFrame, longest: int, frequent, pointers) -> DataFrame:
    """`print`, `lang`, `words`, `phrase`, `check`: the phrase of each fingerprint that is frequent (one
    broadcast map of phrases of all sizes), spelled by the task that it points to (`pointers`, another),
    with its second hash; and for each language rows with 0 words whose `check` counts its words."""
    schema = "print bigint, lang string, words int, phrase binary, check bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own_part = frequent.value, TaskContext.get().partitionId()
        seen: set[int] = set()
        total: dict[str, int] = {}
        names = ["print", "lang", "words", "phrase", "check"]
        for lang, words, first in _pieces(batches, longest):
            total[lang] = total.get(lang, 0) + len(words.start) - first
            for n in range(1, longest + 1):
                at = words.runs(n, first)
                prints = words.prints(at, n, _seed(lang))
                some = np.flatnonzero(bits.held(known, prints))
                some = some[bits.held(pointers.value, _pointed(prints[some], own_part))]
                _, place = np.unique(prints[some], return_index=True)
                some = some[place]
                new = np.array([p not in seen for p in prints[some].tolist()], bool)
                some = some[new] if len(some) else some
                if not len(some):
                    continue
                seen.update(prints[some].tolist())
                start, size = words.spans(at[some], n)
                phrases = [words.data[a : a + b].tobytes() for a, b in zip(start.tolist(), size.tolist())]
                columns = [pa.array(prints[some].view(np.int64)), pa.array([lang] * len(some)), pa.array([n] * len(some), pa.int32())]
                columns += [pa.array(phrases, pa.binary()), pa.array(words.checks(at[some], n))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        for own_lang, n in total.items():
            columns = [pa.array([0], pa.int64()), pa.array([own_lang]), pa.array([0], pa.int32()), pa.array([b""]), pa.array([n])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def spelled(docs: DataFrame, longest: int, frequent: list) -> DataFrame:
    """`lang`, `words`, `phrase`, `n`: texts of all runs that may be frequent, with counts to be added
    up; and for each language rows with 0 words that count its words. `frequent`: one broadcast map
    for each number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [f.value for f in frequent]
        #: language and number of words -> bytes, starts, sizes, fingerprints, counts
        held: dict[tuple[str, int], list[tuple]] = {}
        total: dict[str, int] = {}
        bytes_held = 0

        def folded(parts: list[tuple]) -> tuple:
            shift = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
            data = np.concatenate([p[0] for p in parts])
            start = np.concatenate([p[1] + s for p, s in zip(parts, shift)])
            size, prints, counts = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
            first, count = grouped(data, start, size, prints, counts)
            own, begin = gathered(data, start[first], size[first])
            return own, begin, size[first], prints[first], count

        def given(lang: str, n: int, part: tuple) -> Iterator[pa.RecordBatch]:
            data, begin, size, _, count = part
            for a in range(0, len(begin), 65_536):
                own = slice(a, a + 65_536)
                low, rows = int(begin[a]), len(begin[own])
                ends = np.append(begin[own], begin[own][-1] + size[own][-1]) - low
                text = pa.Array.from_buffers(
                    pa.binary(), rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[low : low + int(ends[-1])].tobytes())]
                )
                names = ["lang", "words", "phrase", "n"]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * rows), pa.array([n] * rows, pa.int32()), text, pa.array(count[own])], names=names)

        for lang, words, first in _pieces(batches, longest):
            total[lang] = total.get(lang, 0) + len(words.start) - first
            data = np.concatenate([words.data, np.zeros(8, np.uint8)])
            for n in range(1, longest + 1):
                prints = words.prints(at := words.runs(n, first), n, _seed(lang))
                some = bits.held(maps[n - 1], prints)
                start, size = words.spans(at[some], n)
                if not len(start):
                    continue
                prints = prints[some]
                chosen, count = grouped(data, start, size, prints, np.ones(len(start), np.int64))
                own, begin = gathered(data, start[chosen], size[chosen])
                held.setdefault((lang, n), []).append((own, begin, size[chosen], prints[chosen], count))
                bytes_held += len(own) + 32 * len(begin)
            if bytes_held > 3 * MOST_BYTES:
                held = {key: [folded(parts)] for key, parts in held.items()}
                bytes_held = sum(len(p[0]) + 32 * len(p[1]) for parts in held.values() for p in parts)
                if bytes_held > MOST_BYTES:
                    for (own_lang, n), parts in held.items():
                        yield from given(own_lang, n, parts[0])
                    held, bytes_held = {}, 0
        for (own_lang, n), parts in held.items():
            yield from given(own_lang, n, folded(parts))
        for own_lang, n in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([own_lang]), pa.array([0], pa.int32()), pa.array([b""]), pa.array([n])], names=["lang", "words", "phrase", "n"]
            )

    return docs.mapInArrow(run, "lang string, words int, phrase binary, n bigint")


def frequent_phrases(docs: DataFrame, longest: int, least: int, lang_col: str, text_col: str, no_lang: str) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to `longest` words that occur `least` times or more in a language (lang, words,
    phrase, f), stored, and the number of words of each language (lang, n)."""
    spark = docs.sparkSession
    picked = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(no_lang)).alias("lang"), F.col(text_col).cast("string").alias("_text"))
    # the latest map for the tasks, and what is frequent of any size
    own, of_all = None, np.zeros(0, np.uint8)
    counted: list[DataFrame] = []
    for n in range(1, longest + 1):
        prints = counted_prints(picked, n, longest, own)
        often = prints.groupBy("print").agg(F.sum("n").alias("n"), (F.sum("check") % CHECKS).alias("check"), F.min("part").alias("part"))
        counted.append(stored(often.where(F.col("n") >= least), "prints"))
        found = bits.bit_map(counted[-1], "print")
        of_all = np.bitwise_or(of_all, found) if len(of_all) else found
        if own is not None:
            own.unpersist()
        own = spark.sparkContext.broadcast(found) if n < longest else None
    known = spark.sparkContext.broadcast(of_all)
    every = reduce(DataFrame.unionAll, counted)
    pointers = spark.sparkContext.broadcast(bits.bit_map(_pointers(every), "pointer"))
    said = stored(spelled_once(picked, longest, known, pointers), "spelled")
    # a bit map may let a second task spell a phrase too
    texts = said.where("words > 0").withColumnRenamed("check", "_check").dropDuplicates(["print"])
    both = stored(every.join(texts, "print", "left"), "phrases")
    agrees = F.col("check") == (F.col("n") % CHECKS) * F.col("_check") % CHECKS
    right = both.where(agrees).select("lang", "words", F.col("phrase").cast("string").alias("phrase"), F.col("n").alias("f"))
    wrong = both.where(~F.coalesce(agrees, F.lit(False)))
    words = said.where("words = 0").groupBy("lang").agg(F.sum("check").alias("n"))
    if not wrong.isEmpty():
        doubtful = spark.sparkContext.broadcast(bits.bit_map(wrong, "print"))
        anew = spelled(picked, longest, [doubtful] * longest).where("words > 0").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
        anew = anew.where(F.col("f") >= least).withColumn("phrase", F.col("phrase").cast("string"))
        # the map lets others pass as well, which are right already
        anew = stored(anew.join(right.select("lang", "phrase"), ["lang", "phrase"], "left_anti").select(*right.columns), "anew")
        right = right.unionByName(anew)
    return right, words


def _part(phrase: Column, first: int, size: Column | int) -> Column:
    """`size` words from word `first` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " ", -1), first, size), " ")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    top: int = 2000,
    covered: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
    no_lang: str = "und",
) -> DataFrame:
    """The best phrases of 2 to `longest` words of each language: lang, rank, phrase, a (its count), l
    and r (counts of its parts at the cut that scores least), n (words of the language) and score.
    Phrases of which a longer candidate around them keeps `covered` percent are left out."""
    phrases, words = frequent_phrases(docs, longest, least, lang_col, text_col, no_lang)
    able = phrases.where("words >= 2")
    inner = []
    for n in range(3, longest + 1):
        parts = [_part(F.col("phrase"), i, size) for size in range(2, n) for i in range(1, n - size + 2)]
        inner.append(able.where(F.col("words") == n).select("lang", F.explode(F.array(*parts)).alias("phrase"), F.col("f").alias("_f")))
    kept = able
    if inner:
        around = inner[0]
        for more in inner[1:]:
            around = around.unionByName(more)
        around = around.groupBy("lang", "phrase").agg(F.max("_f").alias("_around"))
        kept = able.join(around, ["lang", "phrase"], "left").where(
            F.col("_around").isNull() | (F.col("_around") * F.lit(100) < F.col("f") * F.lit(covered))
        )
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"), _part(F.col("phrase"), 1, k).alias("left"), _part_from(F.col("phrase"), k).alias("right")
        ),
    )
    halves = kept.select("lang", "phrase", "f", F.explode(cuts).alias("_c")).select("lang", "phrase", "f", "_c.*")
    counts = phrases.select("lang", F.col("phrase").alias("_part"), F.col("f").alias("_n"))
    for side, name in (("left", "l"), ("right", "r")):
        halves = halves.join(counts.select("lang", F.col("_part").alias(side), F.col("_n").alias(name)), ["lang", side])
    big = "decimal(38,0)"
    square = F.lit(1_000_000).cast("decimal(7,0)") * F.col("f").cast("decimal(15,0)") * F.col("f").cast("decimal(15,0)")
    halves = halves.withColumn("_square", square.cast(big)).withColumn("_product", (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast(big))
    halves = halves.withColumn("score", F.expr("_square div _product"))
    lowest = halves.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "f")).alias("_b"))
    scored = lowest.select("lang", "phrase", F.col("_b.f").alias("a"), "_b.l", "_b.r", "_b.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part first, so that no task sorts all phrases of a language
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _part_from(phrase: Column, k: Column) -> Column:
    """All words behind the first k."""
    words = F.split(phrase, " ", -1)
    return F.array_join(F.slice(words, k + 1, F.size(words)), " ")
