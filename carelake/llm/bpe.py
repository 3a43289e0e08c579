"""Byte-pair encoding by speculation and verification, and decoding.

Words of a text are looked up in a cache; those not seen yet are encoded together. The longest
token is taken greedily from the left, for all words in step, which proposes an encoding. It is the
right one exactly if every token is what its own bytes are merged to and no merge would cross any
boundary of two adjacent tokens; both are tested for all pairs at once. Only words that fail are
merged one merge after the other.

A boundary is tested backwards in time. A token's right edge was, before its last merge, the edge of
its right part, and so on; likewise for left edges. Each of these pieces stood there from the rank
that made it to the rank that used it up. A merge crosses the boundary if two pieces that stood on
its sides at the same time merge at a rank within that time; on equal ranks the left merge is first.

Defined results: null counts as the empty text, which has no tokens; strings of added tokens in a
text are those tokens; every row is encoded by itself, whatever its length, so repeated rows and
other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.words import WordCache

#: the pre-tokenizer's pattern, a fixed value of the format
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: the same for ASCII text
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: signs of white space that is not one space or line end between two stretches
RUNS = ("  ", "\n\n", " \n", "\n ", *map(chr, [9, 11, 12, 13, 28, 29, 30, 31, 133, 160]))
#: characters whose classes are the same in all Unicode versions in use
SETTLED = regex.compile(r"[\u0000-՗‐-⁞₠-₹぀-龥가-힣]*")
NEVER = np.iinfo(np.int64).max
#: words and tokens held by a task's cache before it starts anew
CACHED_WORDS, CACHED_TOKENS = 200_000, 3_000_000
#: bytes of a word up to which words are merged in step
LONG_WORD = 128
#: text put into one output batch
BATCH_CHARS = 4_000_000


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable Latin-1 as it is, the others as
    the letters from U+0100 in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class BytePairs:
    """A vocabulary with its merges."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, letters = held["model"], byte_letters()
        for added in held["added_tokens"]:
            if added["single_word"] or added["lstrip"] or added["rstrip"] or added["normalized"]:
                raise ValueError("added tokens that take in their surroundings are not supported")
        if held["normalizer"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"] or model["ignore_merges"]:
            raise ValueError("only plain byte-level vocabularies are supported")
        self.added = {a["content"]: a["id"] for a in held["added_tokens"]}
        ids = model["vocab"]
        size = 1 + max([*ids.values(), *self.added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            if token not in self.added:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a = np.array([ids[x] for x, _ in pairs], np.int64)
        b = np.array([ids[y] for _, y in pairs], np.int64)
        made = np.array([ids[x + y] for x, y in pairs], np.int64)
        for r in range(len(pairs) - 1, -1, -1):
            self.rank[made[r]], self.left[made[r]], self.right[made[r]] = r, a[r], b[r]
        self.merges = {(int(x), int(y)): (r, int(z)) for r, (x, y, z) in enumerate(zip(a, b, made))}
        self.size = size
        keys = a * size + b
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.made = keys[order], order.astype(np.int64), made
        self.single = np.full(256, -1, np.int64)
        for token, i in ids.items():
            if token not in self.added and len(self.bytes_of[i]) == 1:
                self.single[self.bytes_of[i][0]] = i
        self._trie()
        self.sound = self._sound()

    def _trie(self) -> None:
        """Edges (node, byte) in order, the node each leads to, and the token that ends at a node."""
        below: dict[int, int] = {}
        ends = [-1]
        skipped = set(self.added.values())
        for i, word in enumerate(self.bytes_of):
            if not word or i in skipped:
                continue
            node = 0
            for byte in word:
                key = node * 256 + byte
                node = below.get(key, 0)
                if not node:
                    node = below[key] = len(ends)
                    ends.append(-1)
            ends[node] = i
        keys = np.array(sorted(below), np.int64)
        self.edge_keys, self.edge_to = keys, np.array([below[k] for k in keys.tolist()], np.int64)
        self.ends = np.array(ends, np.int64)

    def _pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray, until: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge of a rank below `until` crosses the boundary of the tokens x and y."""
        good = np.ones(len(x), bool)
        at = np.arange(len(x))
        x_end = np.broadcast_to(np.asarray(until, np.int64), x.shape).copy()
        y_end = x_end - (x_end < NEVER)
        while len(at):
            rank = self._pair_rank(x, y)
            crossed = (rank < x_end) & (rank <= y_end) & (rank < NEVER)
            good[at[crossed]] = False
            x_rank, y_rank = self.rank[x], self.rank[y]
            on = ~crossed & ((x_rank >= 0) | (y_rank >= 0))
            at, x, y, x_end, y_end, x_rank, y_rank = (v[on] for v in (at, x, y, x_end, y_end, x_rank, y_rank))
            later = x_rank > y_rank
            x_end, y_end = np.where(later, x_rank, x_end), np.where(later, y_end, y_rank)
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
        return good

    def _sound(self) -> np.ndarray:
        """Whether a token's own bytes are merged to it."""
        merged = np.flatnonzero(self.rank >= 0)
        sound = np.ones(self.size, bool)
        sound[merged] = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        while True:
            wider = sound.copy()
            wider[merged] &= sound[self.left[merged]] & sound[self.right[merged]]
            if np.array_equal(wider, sound):
                return sound
            sound = wider

    def proposed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches: tokens of all words in order, and how many each word has."""
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(sizes)
        start = stop - sizes
        word = np.flatnonzero(sizes)
        at, last = start[word], stop[word]
        node, best, best_to, cursor = (np.zeros(len(word), np.int64), np.full(len(word), -1), at.copy(), at.copy())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(word):
            key = node * 256 + text[cursor]
            to = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            goes = (cursor < last) & (self.edge_keys[to] == key)
            node = np.where(goes, self.edge_to[to], 0)
            cursor = cursor + goes
            ends = np.where(goes, self.ends[node], -1)
            best, best_to = np.where(ends >= 0, ends, best), np.where(ends >= 0, cursor, best_to)
            done = np.flatnonzero(~goes)
            if len(done):
                if (best[done] < 0).any():
                    raise ValueError("a byte has no token")
                found.append((word[done], at[done], best[done]))
                at[done] = cursor[done] = best_to[done]
                best[done], node[done] = -1, 0
                on = at < last
                word, at, last, node, best, best_to, cursor = (v[on] for v in (word, at, last, node, best, best_to, cursor))
        if not found:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        of, place, token = (np.concatenate(c) for c in zip(*found))
        return token[np.argsort(place)], np.bincount(of, minlength=len(words))

    def merged(self, word: bytes) -> list[int]:
        """One merge after the other: always the lowest rank, the leftmost of equal ones."""
        token = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(token)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        waiting = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (hit := self.merges.get((token[i], token[j]))):
                heapq.heappush(waiting, (hit[0], i, j, token[i], token[j], hit[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while waiting:
            _, i, j, x, y, z = heapq.heappop(waiting)
            if token[i] != x or after[i] != j or token[j] != y:
                continue
            token[i], token[j] = z, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [t for t in token if t >= 0]

    def merged_together(self, words: list[bytes]) -> list[list[int]]:
        """The same for many words in step: in each round every word merges its lowest pair, all
        occurrences from the left, since what a merge makes only takes part in later merges."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        of = np.repeat(np.arange(len(words)), sizes)
        out: list[list[int]] = [[] for _ in words]
        while len(token):
            rank = np.full(len(token), NEVER)
            rank[:-1] = np.where(of[1:] == of[:-1], self._pair_rank(token[:-1], token[1:]), NEVER)
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            upto = np.append(first[1:], len(token))
            for i in np.flatnonzero(lowest == NEVER).tolist():
                out[of[first[i]]] = token[first[i] : upto[i]].tolist()
            lowest = np.repeat(lowest, upto - first)
            hit = np.flatnonzero((rank == lowest) & (rank < NEVER))
            # of pairs that overlap, every second one from the left
            run = np.concatenate([[True], np.diff(hit) > 1]) if len(hit) else np.empty(0, bool)
            since = hit - np.repeat(hit[run], np.diff(np.append(np.flatnonzero(run), len(hit))))
            hit = hit[since % 2 == 0]
            token[hit] = self.made[rank[hit]]
            on = lowest < NEVER
            on[hit + 1] = False
            token, of = token[on], of[on]
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of all words in order, how many each word has, and how many words were merged."""
        token, count = self.proposed(words)
        of = np.repeat(np.arange(len(words)), count)
        failed = np.zeros(len(words), bool)
        failed[of[~self.sound[token]]] = True
        inner = np.flatnonzero(of[1:] == of[:-1])
        # most pairs occur many times
        pair, which = np.unique(token[inner] * self.size + token[inner + 1], return_inverse=True)
        good = self.compatible(pair // self.size, pair % self.size)
        failed[of[inner[~good[which]]]] = True
        wrong = np.flatnonzero(failed)
        if not len(wrong):
            return token, count, 0
        ends = np.cumsum(count)
        short = [w for w in wrong.tolist() if len(words[w]) <= LONG_WORD]
        exact = dict(zip(short, self.merged_together([words[w] for w in short])))
        parts, at = [], 0
        count = count.copy()
        for w in wrong.tolist():
            tokens = exact[w] if w in exact else self.merged(words[w])
            parts += [token[at : ends[w] - count[w]], np.array(tokens, np.int64)]
            at, count[w] = ends[w], len(tokens)
        return np.concatenate([*parts, token[at:]]), count, len(wrong)


class Encoder:
    """Encodes and decodes texts; remembers what it has seen."""

    def __init__(self, pairs: BytePairs) -> None:
        self.pairs = pairs
        self._added = regex.compile("(" + "|".join(map(regex.escape, pairs.added)) + ")") if pairs.added else None
        self._library = None
        self.words_encoded = self.words_merged = 0
        # stretches between white space, and the words that the pattern finds in them
        self._stretches = WordCache(lambda fresh: self._words.encode(self._pieces, fresh), CACHED_WORDS, CACHED_TOKENS)
        self._words = WordCache(self._encode_words, CACHED_WORDS, CACHED_TOKENS)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        token, count, merged = self.pairs.encode_words([b"" if w in self.pairs.added else w.encode() for w in words])
        self.words_encoded += len(words)
        self.words_merged += merged
        for i, word in enumerate(words):
            if word in self.pairs.added:
                token = np.insert(token, int(count[:i].sum()), self.pairs.added[word])
                count[i] = 1
        return token, count

    def _unsettled(self, text: str) -> list[str]:
        """Words of a text with characters that Unicode versions class differently."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.pairs.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _pieces(self, cache: WordCache, text: str) -> Iterator[int]:
        if text in self.pairs.added:
            words = [text]
        elif text.isascii():
            words = ASCII.findall(text)
        else:
            words = PATTERN.findall(text) if SETTLED.fullmatch(text) else self._unsettled(text)
        return map(cache.plain.__getitem__, words)

    def _numbered(self, cache: WordCache, text: str) -> list[int]:
        if self._added is not None and self._added.search(text):
            parts = self._added.split(text)
            return [n for part in parts for n in ([cache.plain[part]] if part in self.pairs.added else self._numbered(cache, part))]
        # no word goes over white space but for one space before it, so where no two of them meet,
        # stretches between them are encoded by themselves
        if not text or text[0] in " \n" or text[-1] in " \n" or any(run in text for run in RUNS):
            return [cache.plain[text]] if text else []
        numbers: list[int] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                numbers.append(cache.plain["\n"])
            first, *others = line.split(" ")
            numbers.append(cache.plain[first])
            numbers += map(cache.spaced.__getitem__, others)
        return numbers

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in order, and how many each text has."""
        return self._stretches.encode(self._numbered, texts)

    def decode(self, tokens: np.ndarray) -> str:
        """The text of the tokens; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pairs.bytes_of.__getitem__, tokens.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(BytePairs(path))


def _portions(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of rows of limited size, as first, last and texts."""
    first, chars, held = 0, 0, []
    for i in range(len(texts)):
        text = texts[i].as_py() or ""
        held.append(text)
        chars += len(text)
        if chars > BATCH_CHARS:
            yield first, i + 1, held
            first, chars, held = i + 1, 0, []
    if held:
        yield first, len(texts), held


def round_trip(docs: DataFrame, path: str, text_col: str = "text", carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, `ids` (array of tokens) and `decoded`, the text that these ids give."""
    picked = docs.select(*carried, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for first, last, texts in _portions(batch.column(batch.num_columns - 1)):
                token, count = coder.encode(texts)
                ends = np.concatenate([[0], np.cumsum(count)])
                back = [coder.decode(token[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(token))
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], ids, pa.array(back, pa.string())], names=[*batch.schema.names[:-1], "ids", "decoded"]
                )

    return picked.mapInArrow(run, f"{kinds}, ids array<int>, decoded string")
