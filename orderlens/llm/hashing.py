"""Vectorised hashing of words and shingles, straight from Arrow's UTF-8 buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64)
_LOWER, _CASED = _BYTE[_FOLD], _BYTE
_WHITE_OUT = np.where(_WHITE, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF))
_LOWER, _CASED = _LOWER & _WHITE_OUT, _CASED & _WHITE_OUT
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)
#: Text is hashed in runs of whole rows of about so many bytes.
RUN_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.grow(RUN_BYTES * 2)

    def grow(self, n: int) -> None:
        self.up, self.down = (np.full(n + 1, base, np.uint64) for base in (_BASE, _BACK))
        for power in (self.up, self.down):
            power[0] = 1
            np.cumprod(power, out=power)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            self.grow(n)
        return self.up, self.down


_POWERS: list[_Powers] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, at least n + 1 of each."""
    if not _POWERS:
        _POWERS.append(_Powers())
    return _POWERS[0].upto(n)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about RUN_BYTES."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a run, and the rows' offsets in words.

    ``outside`` marks the bytes that belong to no word.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~outside[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | breaks[:-1]))
    ends = np.flatnonzero(word & (~after | breaks[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the given byte spans, which hold no white space; A-Z count as a-z if ``lower``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER if lower else _CASED)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a run's words and the rows' offsets among them."""
    starts, ends, rows = spans(data, offsets)
    return span_hashes(data, starts, ends, lower), rows


_PLACE = _RANDOM.integers(1, 2**63, 64, np.uint64) | np.uint64(1)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of ``size`` successive words."""
    n = len(words) - size + 1
    total = np.zeros(max(0, n), np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * _PLACE[k]
    return mix(total + np.uint64(size))


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Per row its sorted distinct shingles of ``size`` lower-cased words.

    Fewer words make one shingle of all of them; none make an empty set.
    """
    for first, end, data, offsets in runs(column):
        words, rows = word_hashes(data, offsets)
        every = windows(words, size)
        for k in range(end - first):
            n = rows[k + 1] - rows[k]
            if n >= size:
                yield np.unique(every[rows[k] : rows[k + 1] - size + 1])
            else:
                yield windows(words[rows[k] : rows[k + 1]], int(n)) if n else words[:0]
