"""Whole Arrow columns of text as numpy arrays: words, word hashes and word shingles, without a loop over rows.

Words are the longest runs of bytes other than the six ASCII white space characters.  Null texts
count as empty.  All hashes are the same in every process and on every machine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x).astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_STEP = _U(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, _U)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        base = np.full(max(n, 2 * len(_POWERS)), _STEP, _U)
        base[0] = 1
        _POWERS = np.multiply.accumulate(base)
    return _POWERS[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text starts (one entry more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of a batch, in order: their hash, the row they are in, and their bytes [start, end) there."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: First word of each row; one entry more than rows.
    first: np.ndarray


def words(column: pa.Array) -> Words:
    data, at = utf8(column)
    rows = len(at) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, _U), none, none, none, np.zeros(rows + 1, np.int64))
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    edge = at[:-1][at[:-1] < len(data)]  # a text starts here, whatever stood before
    begins[edge] = solid[edge]
    last = at[1:][at[1:] > 0] - 1
    ends[last] = solid[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(at, start, "right") - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    if not len(start):
        return Words(np.zeros(0, _U), row, start, end, first)
    length = end - start
    # Words back to back, so that a word's bytes and their places need no white space between.
    skip = np.repeat(start - (np.cumsum(length) - length), length)
    place = np.arange(len(skip))
    begin = np.cumsum(length) - length
    value = _BYTE[data[place + skip]] * powers(int(length.max()))[place - np.repeat(begin, length)]
    total = np.add.reduceat(value, begin)
    return Words(mix64(total + length.astype(_U) * _U(0xA0761D6478BD642F)), row, start, end, first)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each run of ``size`` words.  A text of fewer words, but some, is one shingle."""
    count = np.diff(found.first)
    total = np.zeros(len(found.hash), _U)
    if not len(total):
        return total, np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = np.maximum(np.where(count > 0, 1, 0), count - size + 1)
    rows = np.repeat(np.arange(len(count)), runs)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = found.first[:-1][rows] + place
    total = np.zeros(len(at), _U)
    stop = found.first[1:][rows]
    for k in range(size):
        here = at + k
        inside = here < stop
        word = np.where(inside, found.hash[np.minimum(here, len(found.hash) - 1)], _U(0))
        total = mix64(total + word + _U(k + 1))
    return total, rows, at
