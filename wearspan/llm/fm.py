"""FM-indexes over the word ids of one shard, read in both directions. Runs inside a task, on numpy arrays.

A shard is a sequence of symbols: words have ids from 1, and 0 ends a piece. Its index is two
strings of the last symbols of its sorted rotations: one of the sequence, one of its reverse.
Rotations are sorted by their first ``depth`` symbols only, which is all that phrases of up to
``depth`` words ask of it: a phrase is a range of rows in each of the two orders, and adding a
word at its left maps the one range by counting that word (its rows stay in order) and cuts
the other where that word sorts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def _sorted_places(keys: np.ndarray, most: int) -> np.ndarray:
    """Places in the order of their keys (below most); equal keys stay in order."""
    shift = _bits(len(keys))
    if shift + _bits(most) <= 63:
        return np.sort((keys.astype(np.int64) << shift) | np.arange(len(keys))) & ((1 << shift) - 1)
    return np.argsort(keys, kind="stable")


def last_symbols(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each rotation, rotations sorted by their first depth symbols."""
    most = int(symbols.max(initial=0)) + 1
    keys = symbols.astype(np.int64)
    for ahead in range(1, depth):
        if _bits(most) + _bits(symbols.max(initial=0)) > 62:
            values, keys = np.unique(keys, return_inverse=True)
            most = len(values)
        shift = _bits(symbols.max(initial=0))
        keys = (keys << shift) | np.roll(symbols, -ahead)
        most <<= shift
    return symbols[np.argsort(keys) - 1].astype(np.int32)


@dataclass
class Grams:
    """Distinct phrases of one length: their words, their rows in both orders, and how often a word stands beside them."""

    words: list[np.ndarray]
    low: np.ndarray
    reverse_low: np.ndarray
    count: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def at(self, places: np.ndarray) -> Grams:
        return Grams([w[places] for w in self.words], *[getattr(self, f)[places] for f in ("low", "reverse_low", "count", "left", "right")])


class FmIndex:
    def __init__(self, last: np.ndarray, reverse_last: np.ndarray):
        self.last = last
        self.n_symbols = int(last.max(initial=0)) + 1
        self.counts = np.bincount(last, minlength=self.n_symbols)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.back = np.empty(len(last), dtype=np.int64)
        self.back[_sorted_places(last, self.n_symbols)] = np.arange(len(last))
        self.before = np.concatenate([[0], np.cumsum(last > 0)])
        self.behind = np.concatenate([[0], np.cumsum(reverse_last > 0)])

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int) -> FmIndex:
        return cls(last_symbols(symbols, depth), last_symbols(symbols[::-1], depth))

    def _grams(self, words: list[np.ndarray], low: np.ndarray, reverse_low: np.ndarray, count: np.ndarray) -> Grams:
        left = self.before[low + count] - self.before[low]
        right = self.behind[reverse_low + count] - self.behind[reverse_low]
        return Grams(words, low, reverse_low, count, left, right)

    def single_words(self) -> Grams:
        w = np.flatnonzero(self.counts[1:]) + 1
        return self._grams([w], self.first[w], self.first[w], self.counts[w])

    def extended(self, grams: Grams) -> Grams:
        """All phrases of one word more, at the left, that end in one of the given phrases."""
        total = int(grams.count.sum())
        ends = np.cumsum(grams.count)
        begins = ends - grams.count
        of = np.repeat(np.arange(len(grams)), grams.count)
        rows = np.arange(total) + np.repeat(grams.low - begins, grams.count)
        keys = of * self.n_symbols + self.last[rows]
        order = _sorted_places(keys, len(grams) * self.n_symbols)
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if total else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(heads, total))
        of, word = keys[heads] // self.n_symbols, keys[heads] % self.n_symbols
        low = self.back[rows[order[heads]]]
        reverse_low = grams.reverse_low[of] + heads - begins[of]
        real = np.flatnonzero(word > 0)
        of = of[real]
        return self._grams([word[real], *[w[of] for w in grams.words]], low[real], reverse_low[real], count[real])

    def keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * self.n_symbols + second
