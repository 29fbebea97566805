"""Vectorised word tables over the UTF-8 buffers of Arrow string columns.

ASCII white space never occurs inside a multi-byte character, so words can be cut and hashed
on bytes.  Texts are handled in chunks of at most ``CHUNK_BYTES`` bytes (a longer text is a
chunk of its own), which bounds the numpy temporaries whatever the Arrow batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240229)
_BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    if len(_POW[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[i] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(col: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows' texts) of consecutive row ranges; a
    null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return
    if col.null_count:
        col = col.fill_null("")
    _, offs_buf, data_buf = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(offs_buf, kind, count=n + 1, offset=col.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


class Words:
    """Words of the texts of one chunk: ``start``/``end`` byte positions, ``doc`` row number
    within the chunk, ``count`` words per row, ``first`` index of each row's first word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offs = offs
        n = len(self.data)
        inside = ~IS_SPACE[self.data]
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            edge = offs[1:-1]
            before[edge[edge < n]] = False
            after[edge[edge > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        at = np.searchsorted(self.start, offs)
        self.first = at[:-1]
        self.count = np.diff(at)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word (equal bytes, equal hash)."""
        n = len(self.data)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[self.data] * up[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * down[self.start]
        return mix(h ^ (self.end - self.start).astype(np.uint64))


def row_sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one entry per byte) within each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def windows(h: np.ndarray, first: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of every run of ``size`` words that stays inside its row."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        value = value * np.uint64(0xD1342543DE82EF95) + h[i:n - size + 1 + i]
    ok = np.ones(n - size + 1, bool)
    for back in range(1, size):  # a run may not start in a row's last size-1 words
        at = (first + count - back)[count >= back]
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    at = np.flatnonzero(ok)
    return at, mix(value[at])
