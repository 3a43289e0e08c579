"""Rabin-Karp fingerprints of runs of words, from prefix sums of a polynomial over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: bytes of text that are read at a time
PIECE = 1_000_000

_WORD, _SPACE, _BREAK = 0, 1, 2


def kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: white space, a delimiter that ends a piece, or part of a word."""
    kind = np.zeros(256, np.uint8)
    kind[[*spaces]] = _SPACE
    kind[[*breaks]] = _BREAK
    return kind


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_RANDOM = np.random.default_rng(0x5EED)
#: a random number for each byte, and the odd base of the polynomial, modulo 2^64
_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
#: those of the second hash
_SECOND_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND_BASE = 0xC2B2AE3D27D4EB4F
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse."""
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)])) for b in (base, inverse))


def _grown(size: int) -> tuple[np.ndarray, np.ndarray]:
    # a power of two above, so that few sizes are ever made
    return _powers(1 << max(20, int(size).bit_length()), _BASE)


class Words:
    """The words of some bytes: `data`, lowered, one space behind each. `start` and `size` are each
    word's place there, `at` its place in the bytes given; `piece` numbers the pieces between
    delimiters."""

    def __init__(self, raw: bytes, kind_of: np.ndarray) -> None:
        data = np.append(np.frombuffer(raw, np.uint8), np.uint8(0x0A))
        kind = kind_of[data]
        word = kind == _WORD
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        edge = np.append(0, edge) if word[0] else edge
        start, end = edge[0::2], edge[1::2]
        breaks = np.flatnonzero(kind == _BREAK)
        self.piece = np.searchsorted(breaks, start)
        self.at, self.size = start, end - start
        word[end] = True
        data = _LOWER[data]
        data[end] = 0x20
        self.data = data[word]
        self.start = np.cumsum(self.size + 1) - self.size - 1
        power, self._inverse = _grown(len(self.data))
        self._prefix = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_CODES[self.data] * power[: len(self.data)], out=self._prefix[1:])
        self._second: np.ndarray | None = None

    def checks(self, at: np.ndarray, n: int) -> np.ndarray:
        """A second hash of these runs, of 31 bits, by another polynomial."""
        if self._second is None:
            power, _ = _powers(len(self._inverse) - 1, _SECOND_BASE)
            self._second = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_SECOND_CODES[self.data] * power[: len(self.data)], out=self._second[1:])
        start, size = self.spans(at, n)
        _, inverse = _powers(len(self._inverse) - 1, _SECOND_BASE)
        made = (self._second[start + size] - self._second[start]) * inverse[start]
        return ((made ^ made >> np.uint64(32)) * _MIX >> np.uint64(33)).astype(np.int64)

    def runs(self, n: int, first: int = 0) -> np.ndarray:
        """First words of all runs of n words within a piece that end at word `first` or behind."""
        at = np.arange(max(0, first - n + 1), len(self.start) - n + 1)
        return at[self.piece[at] == self.piece[at + n - 1]] if n > 1 else at

    def spans(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and size in bytes of the runs of n words that begin at these words."""
        last = at + n - 1
        return self.start[at], self.start[last] + self.size[last] - self.start[at]

    def prints(self, at: np.ndarray, n: int, seed: np.uint64) -> np.ndarray:
        """Fingerprints of these runs."""
        start, size = self.spans(at, n)
        made = (self._prefix[start + size] - self._prefix[start]) * self._inverse[start] ^ seed
        made = (made ^ made >> np.uint64(32)) * _MIX
        return made ^ made >> np.uint64(29)


def cut(text: bytes, longest: int, kind_of: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """A text in pieces cut behind white space or delimiters, each with the last words of the piece
    before in front, and how many those are."""
    if len(text) <= PIECE:
        yield text, 0
        return
    start, front, known = 0, b"", 0
    while start < len(text):
        stop = start + PIECE
        while stop < len(text) and kind_of[text[stop]] == _WORD:
            stop += 1
        part = front + text[start:stop]
        yield part, known
        # from the start of the last words on, with all that stands between them
        kind = kind_of[np.frombuffer(part, np.uint8)] == _WORD
        begins = np.flatnonzero(kind & np.concatenate([[True], ~kind[:-1]]))
        known = min(longest - 1, len(begins))
        front = part[begins[-known] :] if known else b""
        start = stop


def same_text(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether `size` bytes from a and from b on are the same, eight bytes at a time. The data has
    eight bytes more behind its last run."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    done = 0
    while len(left):
        # bytes behind the end are shifted out
        beyond = (8 * np.maximum(0, 8 - (size[left] - done))).astype(np.uint64)
        differ = (words[a[left] + done] ^ words[b[left] + done]) << beyond
        same[left[differ != 0]] = False
        done += 8
        left = left[(differ == 0) & (size[left] > done)]
    return same


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the runs one behind the other, eight more, and where each begins."""
    begin = np.cumsum(size) - size
    out = data[np.repeat(start - begin, size) + np.arange(int(size.sum()))]
    return np.concatenate([out, np.zeros(8, np.uint8)]), begin
