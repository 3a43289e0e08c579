"""Tokens of texts by way of remembered words: each word is encoded when a task first meets it."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

Encoded = tuple[np.ndarray, np.ndarray]


class _Numbers(dict):
    """Numbers of strings; one not seen yet gets the next, and is noted as the text it stands for."""

    def __init__(self, cache: WordCache, lead: str) -> None:
        self.cache, self.lead = cache, lead

    def __missing__(self, word: str) -> int:
        number = self[word] = self.cache.size
        self.cache.size += 1
        self.cache.fresh.append(self.lead + word)
        return number


class WordCache:
    """`encode` gives the tokens of a list of words, all in order, and how many each has. The cache
    starts anew between calls once it holds more than `most_words` words or `most_tokens` tokens."""

    def __init__(self, encode: Callable[[list[str]], Encoded], most_words: int, most_tokens: int) -> None:
        self._encode, self._most = encode, (most_words, most_tokens)
        self._forget()

    def _forget(self) -> None:
        self.size, self.fresh = 0, []
        #: numbers of words as they are, and of words that follow one space
        self.plain, self.spaced = _Numbers(self, ""), _Numbers(self, " ")
        self._tokens = np.empty(0, np.int32)
        self._starts, self._counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, numbered: Callable[[WordCache, str], Iterable[int]], texts: Iterable[str]) -> Encoded:
        """Tokens of all texts in order, and how many each has. `numbered` gives a text's words as
        numbers that it gets from `plain` and `spaced`."""
        if self.size > self._most[0] or len(self._tokens) > self._most[1]:
            self._forget()
        flat_words: list[int] = []
        upto = [0]
        for text in texts:
            flat_words += numbered(self, text)
            upto.append(len(flat_words))
        if self.fresh:
            token, count = self._encode(self.fresh)
            self._starts = np.concatenate([self._starts, len(self._tokens) + np.cumsum(count) - count])
            self._counts = np.concatenate([self._counts, count])
            self._tokens = np.concatenate([self._tokens, token.astype(np.int32)])
            self.fresh = []
        flat = np.array(flat_words, np.int64)
        count = self._counts[flat]
        ends = np.concatenate([[0], np.cumsum(count)])
        token = self._tokens[np.repeat(self._starts[flat] - ends[:-1], count) + np.arange(ends[-1])]
        return token, np.diff(ends[upto])
