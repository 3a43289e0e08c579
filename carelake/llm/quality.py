"""Quality rules: plain text statistics, and perplexity under an n-gram model of the corpus itself.

Tasks count the n-grams of five code points of their documents by language, Spark adds the counts up
over all different texts of a language, each counted once however many copies it has. Modified
Kneser-Ney smoothing is a grouping by context and a join with the shorter n-gram for every order:
what is left of a context's mass after the discounts goes to the shorter n-grams. From two code
points on, n-grams met only once are left out of the model, so that a text does not predict its own
noise; their mass goes to the shorter ones too. Every n-gram that was counted has a probability, and
the documents judged are those counted, so none is looked up in vain.

Probabilities are stored as arrays sorted by a 64-bit hash, in parts of about `PART_ROWS` entries by
language and range of hashes. The model grows with the corpus and is never held whole: documents are
scored against blocks of parts, at most `BLOCK_ROWS` entries or one part each, which is all that is
sent to the tasks at once. A block reads only the documents of its languages, and a text's log
probability is the sum of what the blocks find. So neither n-grams nor languages are limited; a
model of several blocks costs as many scans of the texts.

A document's perplexity is that of all its characters. Language-specific bands, `SPREADS` robust
deviations around the median of the language's different texts that pass the plain rules, reject documents
on either side: below are repeated or degenerate texts, above is noise. Short documents scatter
more, so a band is widened by `SHORT` divided by the root of the number of characters.

Code points of the first plane are folded to lower case where that is one code point; U+0000 and
U+0001 count as U+FFFD.

Defined results: a null text has no words and fails the plain rules; null languages are one language;
a language whose documents all fail the plain rules has no band and none of its documents is kept;
every row, repeated or not, is judged, while model and band take each text once; an empty table gives no rows. Texts are read whole,
in pieces. Other columns are carried along on request, or not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import bits
from carelake.llm.common import plainly_named, stored
from carelake.llm.simhash import word_pieces

ORDER = 5
#: before the first character of a text
EDGE = 1
#: characters that a task counts or scores at a time
PIECE = 1 << 22
#: entries of a part of the model, and of the parts that are sent to the tasks at once (12 bytes each)
PART_ROWS, BLOCK_ROWS = 1 << 20, 1 << 22
#: n-grams of two and more code points met less often are left to shorter ones
LEAST_MET = 2
#: robust deviations of the band, its least deviation, and its widening for short texts
SPREADS, LEAST_SPREAD, SHORT = 4.0, 0.01, 0.5
#: bins of log perplexity from which medians are taken, per unit
BINS = 2000
#: fixed values of the plain rules
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOL_CHARS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

_FOLDED: np.ndarray | None = None


def _folds() -> np.ndarray:
    """Lower-case code points of those of the first plane."""
    global _FOLDED
    if _FOLDED is None:
        low = [chr(c).lower() for c in range(1 << 16)]
        _FOLDED = np.array([ord(x) if len(x) == 1 and ord(x) >> 16 == 0 else c for c, x in enumerate(low)], np.uint32)
    return _FOLDED


def points(texts: Iterable[str]) -> np.ndarray:
    """Code points of the texts, each after the edges of its first n-grams; every other place ends an n-gram."""
    lead = chr(EDGE) * (ORDER - 1)
    joined = "".join(lead + t.replace("\0", "\ufffd").replace(chr(EDGE), "\ufffd") for t in texts)
    p = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(p) or p.max() <= 0xFFFF:
        return _folds()[p]
    return np.where(p > 0xFFFF, p, _folds()[np.minimum(p, 0xFFFF)])


def plain_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    numbers: dict[bytes, int] = {}
    pieces = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in p), np.int64, len(p)) for p in word_pieces(data)]
    words = np.concatenate([np.empty(0, np.int64), *pieces])
    chars = len(text) - sum(text.count(s) for s in _SPACES)
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            repeated_lines += line in seen
            seen.add(line)
    repeated = np.zeros(len(words), bool)
    if len(words) > 3:
        _, pair = np.unique(words[:-2] * len(numbers) + words[1:-1], return_inverse=True)
        _, which, times = np.unique(pair * len(numbers) + words[2:], return_inverse=True, return_counts=True)
        again = times[which] > 1
        for i in range(3):
            repeated[i : len(words) - 2 + i] |= again
    return len(words), chars, sum(text.count(s) for s in SYMBOL_CHARS), repeated_lines, int(repeated.sum())


def fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def _key(lang: Column) -> Column:
    """The language as a value that is never null."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def _picked(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(_key(F.col(lang_col)).alias("_key"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")


def digest(key: str, text: str) -> bytes:
    """128 bits that stand for a text of a language."""
    return hashlib.blake2b(f"{key}\0{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _mark(of: bytes) -> int:
    return int.from_bytes(of[:8], "big", signed=True)


def _spelled(piece: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different n-grams of a piece, as rows of code points, and how often each is there."""
    n = len(piece) - ORDER + 1
    if n <= 0:
        return
    letters = np.unique(piece)
    base = len(letters)
    if base**ORDER >= 1 << 64:
        # fewer characters have fewer letters, and a few thousand always fit
        yield from _spelled(piece[: n // 2 + ORDER - 1])
        yield from _spelled(piece[n // 2 :])
        return
    number = np.zeros(int(letters[-1]) + 1, np.uint64)
    number[letters] = np.arange(base, dtype=np.uint64)
    digits = number[piece]
    packed = np.zeros(n, np.uint64)
    for i in range(ORDER):
        packed = packed * np.uint64(base) + digits[i : i + n]
    packed, times = np.unique(packed[piece[ORDER - 1 :] != EDGE], return_counts=True)
    grams = np.empty((len(packed), ORDER), np.uint32)
    for i in reversed(range(ORDER)):
        packed, last = np.divmod(packed, np.uint64(base))
        grams[:, i] = letters[last.astype(np.int64)]
    yield grams, times


def _pieces(flat: np.ndarray) -> Iterator[np.ndarray]:
    for first in range(0, len(flat) - ORDER + 1, PIECE):
        yield flat[first : first + PIECE + ORDER - 1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows of key and text: key, gram, n, each gram perhaps more than once."""
    waiting: dict[str, list[str]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for key, texts in waiting.items():
            for piece in _pieces(points(texts)):
                for grams, times in _spelled(piece):
                    spelled = pa.array(grams.view(f"<U{ORDER}").reshape(-1), pa.string())
                    columns = [pa.array([key] * len(times), pa.string()), spelled, pa.array(times, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["_key", "gram", "n"])

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            waiting.setdefault(key.as_py(), []).append(text)
            held += len(text)
            if held >= PIECE:
                yield from rows()
                waiting, held = {}, 0
    yield from rows()


def counted(docs: DataFrame, marked: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """_key, gram, n: how often each n-gram is in all different texts of a language.

    `marked` has the `_mark` of every row. Texts whose mark occurs once are counted where they are
    read; only the others are shuffled to be compared, copies collapsing in the tasks.
    """
    repeated = marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = docs.sparkSession.sparkContext.broadcast(bits.bit_map(repeated, "_mark"))

    def pick(batches: Iterator[pa.RecordBatch], copies: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [_mark(digest(k.as_py(), t.as_py())) for k, t in zip(batch.column(0), batch.column(1))]
            chosen = bits.held(several.value, np.array(marks, np.int64)) == copies
            yield batch.filter(pa.array(chosen))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(pick(batches, False))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pick(batches, True)

    picked = _picked(docs, text_col, lang_col)
    schema = "_key string, gram string, n bigint"
    copies = picked.mapInArrow(often, "_key string, _text string").distinct()
    parts = picked.mapInArrow(once, schema).unionByName(copies.mapInArrow(_count, schema))
    return parts.groupBy("_key", "gram").agg(F.sum("n").alias("n"))


def _discounted(level: DataFrame, order: int) -> DataFrame:
    """Adds `own`, what an n-gram keeps of its count; discounts come from the language's counts of counts."""
    tally = level.groupBy("_key").agg(*(F.sum((F.col("n") == k).cast("long")).alias(f"t{k}") for k in range(1, 5)))
    t = [F.col(f"t{k}") for k in range(1, 5)]
    base = F.when(t[0] + t[1] > 0, t[0] / (t[0] + 2 * t[1])).otherwise(0.0)
    cuts = []
    for k in range(1, 4):
        found = F.when(t[k - 1] > 0, k - (k + 1) * base * t[k] / F.nullif(t[k - 1], F.lit(0))).otherwise(base * k)
        cuts.append(F.least(F.greatest(found, F.lit(0.0)), F.lit(float(k))).alias(f"d{k}"))
    joined = level.join(tally.select("_key", *cuts), "_key")
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    own = F.col("n") - cut
    if order > 1:
        own = F.when(F.col("met") >= LEAST_MET, own).otherwise(0.0)
    return joined.withColumn("own", own).drop("d1", "d2", "d3")


def probabilities(counts: DataFrame) -> DataFrame:
    """_key, gram, p: the probability of an n-gram's last code point after the others.

    The shortest n-grams of a language meet in one window, one row for each code point in use.
    """
    levels = {ORDER: counts.withColumn("met", F.col("n"))}
    for order in range(ORDER - 1, 0, -1):
        # after how many different code points the shorter n-gram occurs
        shorter = levels[order + 1].select("_key", F.substring("gram", 2, order).alias("gram"), "met")
        levels[order] = stored(shorter.groupBy("_key", "gram").agg(F.count(F.lit(1)).alias("n"), F.sum("met").alias("met")), f"grams-{order}")
    known: DataFrame | None = None
    for order in range(1, ORDER + 1):
        context = Window.partitionBy("_key", F.substring("gram", 1, order - 1))
        total = F.sum("n").over(context)
        level = _discounted(levels[order], order).withColumn("rest", 1 - F.sum("own").over(context) / total).withColumn("own", F.col("own") / total)
        if known is None:
            lower = 1 / (F.count(F.lit(1)).over(context) + 1)
            known = level.select("_key", "gram", (F.col("own") + F.col("rest") * lower).alias("p"))
        else:
            below = known.select("_key", F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            level = level.withColumn("shorter", F.substring("gram", 2, order - 1))
            known = level.join(below, ["_key", "shorter"]).select("_key", "gram", (F.col("own") + F.col("rest") * F.col("lower")).alias("p"))
        known = stored(known, f"model-{order}")
    return known


def hashed(letters: Iterable[np.ndarray], n: int) -> np.ndarray:
    """64-bit hashes of n n-grams; array i of `letters` has their i-th code points."""
    x = np.zeros(n, np.uint64)
    for column in letters:
        x ^= column
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def parts(known: DataFrame) -> DataFrame:
    """_key, part, size, keys, values: the hashes in order and their log probabilities, as bytes."""
    sizes = known.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts"))
    placed = known.join(sizes, "_key").select("_key", F.pmod(F.xxhash64("gram"), "_parts").alias("part"), "gram", F.log("p").alias("p"))

    def made(group: pa.Table) -> pa.Table:
        grams = "".join(group.column("gram").to_pylist()).encode("utf-32-le")
        letters = np.frombuffer(grams, "<u4").reshape(-1, ORDER).T
        keys = hashed(letters, letters.shape[1])
        rank = np.argsort(keys)
        values = group.column("p").to_numpy()[rank].astype(np.float32)
        columns = {"_key": group.column("_key")[:1], "part": group.column("part")[:1], "size": pa.array([len(keys)], pa.int64())}
        return pa.table({**columns, "keys": pa.array([keys[rank].tobytes()], pa.binary()), "values": pa.array([values.tobytes()], pa.binary())})

    return placed.groupBy("_key", "part").applyInArrow(made, "_key string, part bigint, size bigint, keys binary, values binary")


class Arrays:
    """Sorted hashes with their log probabilities; the upper bits of a hash tell where to start."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        rank = np.argsort(keys, kind="stable")
        #: the last entry stops every search
        self.keys = np.append(keys[rank], np.uint64(2**64 - 1))
        self.values = np.append(values[rank], np.float32(0))
        width = max(len(keys).bit_length(), 1)
        self._shift = np.uint64(64 - width)
        self._starts = np.searchsorted(self.keys, np.arange(1 << width, dtype=np.uint64) << self._shift)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Log probabilities of the hashes, 0 for those that are not here."""
        at = self._starts[(wanted >> self._shift).astype(np.int64)]
        behind = np.flatnonzero(self.keys[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < wanted[behind]]
        return np.where(self.keys[at] == wanted, self.values[at], np.float32(0))

    def sums(self, texts: list[str]) -> np.ndarray:
        """What the n-grams of each text add up to, taking those that are here."""
        flat = points(texts)
        owner = np.repeat(np.arange(len(texts)), [len(t) + ORDER - 1 for t in texts])
        out = np.zeros(len(texts))
        for place, piece in enumerate(_pieces(flat)):
            # n-grams that end at an edge are in no model
            n = len(piece) - ORDER + 1
            values = self.find(hashed([piece[i : i + n] for i in range(ORDER)], n))
            first = place * PIECE + ORDER - 1
            out += np.bincount(owner[first : first + n], values, len(texts))
        return out


def _blocks(model: DataFrame) -> Iterator[tuple[list[str], Broadcast]]:
    """The model in blocks: the languages in each, and their arrays."""
    named = model.select("_key", "part", "size").orderBy("_key", "part").toLocalIterator()

    def fetched(chosen: list[tuple[str, int]]) -> tuple[list[str], Broadcast]:
        keys = sorted({k for k, _ in chosen})
        wanted = F.struct("_key", "part").isin([F.struct(F.lit(k), F.lit(p).cast("long")) for k, p in chosen])
        arrays: dict[str, list] = {}
        for row in model.where(F.col("_key").isin(keys) & wanted).collect():
            arrays.setdefault(row["_key"], []).append((np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["values"], np.float32)))
        joined = {k: tuple(np.concatenate(x) for x in zip(*a)) for k, a in arrays.items()}
        return keys, model.sparkSession.sparkContext.broadcast(joined)

    chosen, size = [], 0
    for row in named:
        if chosen and (size + row["size"] > BLOCK_ROWS or len(chosen) == 256):
            yield fetched(chosen)
            chosen, size = [], 0
        chosen.append((row["_key"], row["part"]))
        size += row["size"]
    if chosen:
        yield fetched(chosen)


def perplexities(docs: DataFrame, model: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """_of, _sum: the digest of each different text, and its log probability."""
    found: DataFrame | None = None
    for number, (keys, block) in enumerate(_blocks(model)):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            held = {key: Arrays(*arrays) for key, arrays in block.value.items()}
            for batch in batches:
                waiting: dict[str, dict[bytes, str]] = {}
                chars = 0
                for i in range(batch.num_rows):
                    key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                    waiting.setdefault(key, {})[digest(key, text)] = text
                    chars += len(text)
                    if chars < PIECE and i < batch.num_rows - 1:
                        continue
                    for key, texts in waiting.items():
                        sums = held[key].sums(list(texts.values()))
                        yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array(sums)], names=["_of", "_sum"])
                    waiting, chars = {}, 0

        rows = _picked(docs, text_col, lang_col).where(F.col("_key").isin(keys)).mapInArrow(run, "_of binary, _sum double")
        rows = stored(rows.groupBy("_of").agg(F.max("_sum").alias("_sum")), f"block-{number}")
        block.destroy()
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return docs.sparkSession.createDataFrame([], "_of binary, _sum double")
    return found.groupBy("_of").agg(F.sum("_sum").alias("_sum"))


def scored(docs: DataFrame, carried: list[str], text_col: str, lang_col: str, keep_text: bool) -> DataFrame:
    """The carried columns with the plain statistics, `_key`, `_chars`, `_digest` and `_mark` of
    the text, `_text` on request, and base_failed."""
    picked = docs.select(*carried, _key(F.col(lang_col)).alias("_key"), F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "_text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                rows = batch.slice(first, 1000)
                made, digests = [], []
                for key, text in zip(rows.column(rows.num_columns - 2).to_pylist(), rows.column(rows.num_columns - 1)):
                    text = text.as_py() or ""
                    made.append((*plain_statistics(text), len(text)))
                    digests.append(digest(key, text))
                statistics = [pa.array([m[i] for m in made], pa.int64()) for i in range(len(names))]
                marks = pa.array([_mark(d) for d in digests], pa.int64())
                columns = [*rows.columns[:-1], *statistics, pa.array(digests, pa.binary()), marks]
                made_names = [*rows.schema.names[:-1], *names, "_digest", "_mark"]
                if keep_text:
                    columns, made_names = [*columns, rows.columns[-1]], [*made_names, "_text"]
                yield pa.RecordBatch.from_arrays(columns, names=made_names)

    text = ", _text string" if keep_text else ""
    out = picked.mapInArrow(run, f"{kinds}, {', '.join(f'{n} bigint' for n in names)}, _digest binary, _mark bigint{text}")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def bands(texts: DataFrame) -> DataFrame:
    """_of_key, _middle, _spread: median and robust deviation of the log perplexity of each language's
    texts, from counts of fine bins. `texts`: _key, _log_perplexity."""
    binned = texts.select("_key", F.floor(F.col("_log_perplexity") * BINS).alias("bin")).groupBy("_key", "bin").agg(F.count(F.lit(1)).alias("n"))
    middle = binned.groupBy(F.col("_key").alias("_of_key")).agg(F.percentile("bin", F.lit(0.5), F.col("n")).alias("_middle"))
    away = binned.join(middle, F.col("_key") == F.col("_of_key")).select("_of_key", "_middle", F.abs(F.col("bin") - F.col("_middle")).alias("away"), "n")
    spread = 1.4826 * F.percentile("away", F.lit(0.5), F.col("n")) / BINS
    found = away.groupBy("_of_key", "_middle").agg(F.greatest(spread, F.lit(LEAST_SPREAD)).alias("_spread"))
    return found.withColumn("_middle", (F.col("_middle") + 0.5) / BINS)


def model_of(docs: DataFrame, marked: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return stored(parts(probabilities(stored(counted(docs, marked, text_col, lang_col), "ngrams"))), "model")


def judged(
    docs: DataFrame, carried: list[str], text_col: str = "text", lang_col: str = "lang", keep_text: bool = False
) -> DataFrame:
    """The carried columns with the plain statistics, base_failed, log_perplexity, and kept; on
    request also `_text`, the text."""
    marked = stored(scored(docs, carried, text_col, lang_col, keep_text), "statistics")
    scores = stored(perplexities(docs, model_of(docs, marked, text_col, lang_col), text_col, lang_col), "scores")
    perplexity = (-F.col("_sum") / F.nullif(F.col("_chars"), F.lit(0))).alias("_log_perplexity")
    passing = marked.where("NOT base_failed").select("_digest", "_key", "_chars").distinct()
    texts = passing.join(scores, F.col("_digest") == F.col("_of")).select("_key", perplexity)
    limits = stored(bands(texts), "bands")
    # one small row for each text and for each language
    both = marked.join(scores, F.col("_digest") == F.col("_of"), "left").withColumn("log_perplexity", perplexity)
    off = F.abs(F.col("log_perplexity") - F.col("_middle"))
    allowed = SPREADS * F.col("_spread") + SHORT / F.sqrt(F.col("_chars"))
    kept = ~F.col("base_failed") & F.coalesce(off <= allowed, F.lit(False))
    return (
        both.join(limits, F.col("_key") == F.col("_of_key"), "left")
        .withColumn("kept", kept)
        .drop("_key", "_of_key", "_middle", "_spread", "_chars", "_digest", "_mark", "_of", "_sum")
    )


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns."""
    plain, named, back = plainly_named(docs)
    text = named[text_col]
    others = [c for c in plain.columns if c != text]
    kept = judged(plain, others, text, named[lang_col], keep_text=True).where("kept")
    return kept.withColumnRenamed("_text", text).select(*back)
