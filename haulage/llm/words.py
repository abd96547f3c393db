"""Words and their hashes from Arrow text columns, without a Python string per word.

A word is a run of bytes other than space and the controls 9 to 13. In UTF-8
these are single bytes, so bytes and code points give the same words. Hashes
are 64-bit: a polynomial over the word's bytes, taken from prefix sums so that
all words of a chunk are hashed at once, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 17  # of 8 bytes a number for each byte, arrays then fit in a processor's cache

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base & _MASK, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(_BASE)
_WORD_POWERS = _Powers(0xD1342543DE82EF95)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values (a bijection for each seed)."""
    h = h ^ np.uint64((seed * 0x9E3779B97F4A7C15) & _MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(values: np.ndarray, powers: _Powers) -> np.ndarray:
    up, _ = powers.upto(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, dtype=np.uint64, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, powers: _Powers, starts, ends, length=None) -> np.ndarray:
    """Hashes of [start, end) ranges, alike wherever the same values stand.

    With ranges of one ``length``, starts and ends may be slices.
    """
    _, down = powers.upto(len(sums))
    length = (ends - starts).astype(np.uint64) if length is None else np.uint64(length)
    return mix((sums[ends] - sums[starts]) * down[starts], 1) + length


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every run of ``length`` consecutive word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return range_hashes(prefix_sums(words, _WORD_POWERS), _WORD_POWERS, slice(0, n), slice(length, None), length)


def byte_grams(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every run of ``length`` consecutive values (bytes or code points)."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), _BYTE_POWERS)
    return range_hashes(sums, _BYTE_POWERS, slice(0, n), slice(length, None), length)


@dataclass
class Words:
    """The words of rows ``first`` to ``last`` of a column.

    ``row`` is the word's row, counted from ``first``; ``heads`` are hashes of the word's
    leading bytes, one array for each asked length.
    """

    first: int
    last: int
    row: np.ndarray
    hash: np.ndarray
    heads: list[np.ndarray]

    def offsets(self) -> np.ndarray:
        """Where each row's words begin, and the end of the last."""
        return np.searchsorted(self.row, np.arange(self.last - self.first + 1))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), starts


def chunks(starts: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _pieces(data: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Cut a long range between words, so that temporary arrays stay small."""
    while end - begin > 2 * CHUNK_BYTES:
        cut = begin + CHUNK_BYTES
        while cut < end:
            spaces = np.flatnonzero(_SPACE[data[cut : min(cut + 65536, end)]])
            if len(spaces):
                cut += int(spaces[0])
                break
            cut = min(cut + 65536, end)
        yield begin, cut
        begin = cut
    yield begin, end


def _hash_piece(data, begin, end, row_starts, lower, heads):
    piece = data[begin:end]
    if lower:
        piece = _LOWER[piece]
    solid = ~_SPACE[piece]
    first = np.zeros(len(piece) + 1, dtype=bool)
    inner = row_starts - begin
    first[inner[(inner >= 0) & (inner <= len(piece))]] = True
    before = np.concatenate(([False], solid[:-1]))
    after = np.concatenate((solid[1:], [False]))
    begins = np.flatnonzero(solid & (first[:-1] | ~before))
    ends = np.flatnonzero(solid & (first[1:] | ~after)) + 1
    sums = prefix_sums(piece.astype(np.uint64) + np.uint64(1), _BYTE_POWERS)
    hashes = range_hashes(sums, _BYTE_POWERS, begins, ends)
    fronts = [
        range_hashes(sums, _BYTE_POWERS, begins, np.minimum(begins + n, ends)) for n in heads
    ]
    rows = np.searchsorted(row_starts, begins + begin, side="right") - 1
    return [rows, hashes, *fronts]


def words_of(column: pa.Array, lower: bool = False, heads: tuple[int, ...] = ()) -> Iterator[Words]:
    """The words of a text column, in chunks of rows. ``lower`` folds A-Z only."""
    data, starts = flat(column)
    for first, last in chunks(starts):
        row_starts = starts[first : last + 1]
        parts = [
            _hash_piece(data, a, b, row_starts[:-1], lower, heads)
            for a, b in _pieces(data, int(row_starts[0]), int(row_starts[-1]))
            if b > a
        ]
        if parts:
            row, hashes, *fronts = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            row, hashes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
            fronts = [hashes] * len(heads)
        yield Words(first, last, row, hashes, fronts)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from all its values and where each row's begin."""
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, kind)
    )
