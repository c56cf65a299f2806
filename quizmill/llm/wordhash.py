"""Hashes of the words of many texts at once, straight from Arrow's buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, the same as the pattern
``[^\\x20\\x09-\\x0D]+`` on the text. A word's hash is a polynomial in its bytes modulo 2**64; the
hash of consecutive words is a polynomial in the words' hashes, so both come from prefix sums
(the rolling hash of Rabin and Karp) and a scrambling step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes and rows of text taken at once; a longer text is taken alone.
CHUNK_BYTES, CHUNK_ROWS = 1 << 20, 1024

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS.copy()
_LOWER[65:91] += 32
_U = np.uint64
_BYTE_BASE, _WORD_BASES = 0x9E3779B97F4A7C15 | 5, (0xD6E8FEB86659FD93 | 5, 0xA0761D6478BD642F | 5)


def scramble(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x + _U((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = scramble(np.arange(256, dtype=np.uint64), 7)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below n; kept for the usual sizes only."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1) if base == _BYTE_BASE else max(n, 1 << 18)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size <= CHUNK_BYTES + 1:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def prefix_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers and inverse powers for hashes of word sequences."""
    return _powers_of(_WORD_BASES[0], n)


@dataclass
class Words:
    """The words of consecutive texts: places in ``data``, hash, and where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of text i: words first[i] to first[i + 1]
    lo: int  # number of the first text in its batch
    n: int

    def runs(self, at: np.ndarray, length: np.ndarray | int, which: int = 0) -> np.ndarray:
        """Hashes of the ``length`` words from each word of ``at`` on; ``which`` of two independent ones."""
        up, down = _powers_of(_WORD_BASES[which], len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[:-1], out=total[1:])
        return scramble((total[at + length] - total[at]) * down[at] + _U(0x632BE59BD9B4E019) * np.asarray(length, np.uint64))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls become empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)), offsets


def words_of(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a batch's texts, about ``CHUNK_BYTES`` at a time; only some rows are converted at once."""
    for base in range(0, len(column), CHUNK_ROWS):
        data, offsets = _buffers(column.slice(base, CHUNK_ROWS))
        lo, rows = 0, len(offsets) - 1
        while lo < rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
            hi = min(hi, rows)
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            yield _words(part, at, base + lo, lower)
            lo = hi


def _words(data: np.ndarray, at: np.ndarray, lo: int, lower: bool) -> Words:
    n = len(at) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), lo, n)
    white = _WHITE[data]
    before = np.concatenate(([True], white[:-1]))
    before[at[:-1][at[:-1] < len(data)]] = True
    after = np.concatenate((white[1:], [True]))
    after[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(~white & before)
    end = np.flatnonzero(~white & after) + 1
    up, down = _powers_of(_BYTE_BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[(_LOWER if lower else _AS_IS)[data]] * up[:-1], out=total[1:])
    h = scramble((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, h, np.searchsorted(start, at).astype(np.int64), lo, n)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number and distinct shingle hashes, in order, of each text with words, ``A-Z`` lower-cased.

    A text of fewer than ``width`` words has its whole sequence as one shingle."""
    for w in words_of(column, lower=True):
        count = np.diff(w.first)
        length = np.minimum(count, width)
        number = np.where(count > 0, np.maximum(count - width + 1, 1), 0)
        cut = np.concatenate(([0], np.cumsum(number)))
        text = np.repeat(np.arange(w.n), number)
        at = w.first[:-1][text] + np.arange(cut[-1]) - cut[:-1][text]
        h = w.runs(at, length[text])
        for i in np.flatnonzero(number):
            yield w.lo + int(i), np.unique(h[cut[i] : cut[i + 1]])
