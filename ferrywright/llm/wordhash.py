"""Words of many texts at once, and 64-bit hashes of words and word runs, as numpy passes over the bytes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; bytes of UTF-8 sequences are never among these,
so the words are those of ``[^\\x20\\x09-\\x0D]+`` on the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 1 << 21  # texts are worked on in slices of about so many bytes, a longer text alone

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 1))
        row = np.full(size, base, np.uint64)
        row[0] = 1
        _powers[base] = np.cumprod(row, dtype=np.uint64)
    out = _powers[base][:n]
    if len(_powers[base]) > 4 * SLICE_BYTES:  # a very long text: don't hold its powers
        del _powers[base]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """A slice of a text column as one byte buffer with the borders of texts and words."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        n = len(column)
        buffers = column.buffers()
        off = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(buffers[2], np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
        self.data, self.off = data, off - off[0]
        solid = np.zeros(len(data) + 2, bool)
        solid[1:-1] = ~_SPACE[data]
        border = np.zeros(len(data) + 1, bool)
        border[self.off] = True
        self.starts = np.flatnonzero(solid[1:] & (~solid[:-1] | border))
        self.ends = np.flatnonzero(solid[:-1] & (~solid[1:] | border))
        self.doc = np.searchsorted(self.off, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])  # index of each text's first word

    def hashes(self, fold: bool = False) -> np.ndarray:
        """A hash of each word; with ``fold``, A-Z count as a-z."""
        codes = (_FOLDED if fold else _CODES)[self.data] * _power(_BASE, len(self.data))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)])
        return mix((total[self.ends] - total[self.starts]) * _power(_BASE_INVERSE, len(self.data) + 1)[self.starts])

    def runs(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of each run of ``k`` words within one text."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _power(_BASE, n), dtype=np.uint64)])
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return at, mix((total[at + k] - total[at]) * _power(_BASE_INVERSE, n)[at])


def slices(column: pa.Array, size: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold about ``size`` bytes, and at most ``rows`` texts, each."""
    lengths = np.asarray(pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    total, start = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (total + n > size or i - start == rows):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
