"""Rolling hashes over Arrow string columns, vectorised across documents.

A column is cut into blocks of whole documents of about BLOCK_BYTES (one document if it
is larger), and each block is hashed at once. Hashes are polynomials modulo 2**64 over
units that a random table spreads to 64 bits, finished by a mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Odd bases of the two independent polynomials.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: The six characters that separate words: space and \t \n \v \f \r.
SPACES = bytes([0x20, 9, 10, 11, 12, 13])
IS_SPACE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SPACES, np.uint8))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (as of public hash finalisers)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=4)
def _byte_table(which: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[which]) + np.uint64(which))


@lru_cache(maxsize=4)
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1."""
    base = BASES[which]
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(which, 1 << max(16, int(n - 1).bit_length()))
    return up[:n], down[:n]


class Prefix:
    """Prefix sums of a polynomial over units, for the hash of any run of units."""

    def __init__(self, units: np.ndarray, which: int = 0):
        """units: bytes (spread by a table) or 64-bit values (taken as they are)."""
        if units.dtype == np.uint8:
            units = _byte_table(which)[units]
        up, self._down = powers(which, len(units) + 1)
        self._sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[:-1], out=self._sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hashes of the units [start, end)."""
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def grams(self, size: int) -> np.ndarray:
        """Mixed hashes of all runs of `size` units."""
        if len(self._sums) <= size:
            return np.zeros(0, np.uint64)
        return mix((self._sums[size:] - self._sums[:-size]) * self._down[: len(self._sums) - size])


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of blocks of whole documents; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary()).cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if n and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """The words of a block: maximal runs of bytes outside SPACES, never across documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        inside = ~IS_SPACE[data] if len(data) else np.zeros(0, bool)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Words before each document, and in all.
        self.offsets = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return Prefix(self.data, which).hash(self.starts, self.ends)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The document of each unit."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """For each run of `size` values the index of its least one, the rightmost of equals."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # least (value, -index): doubling spans, the right one wins ties
    best, span = np.arange(len(values)), 1
    while span * 2 <= size:
        left, right = best[: len(best) - span], best[span:]
        best = np.where(values[right] <= values[left], right, left)
        span *= 2
    left, right = best[:n], best[size - span : size - span + n]
    return np.where(values[right] <= values[left], right, left)
