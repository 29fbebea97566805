"""Spans of texts that a tokenizer encodes independently of what is around them.

``pre_tokens`` cuts rows into the pre-tokens of the byte-level pattern without running a regular
expression: every rule of the pattern becomes a condition on neighbouring characters' classes.
``bigram_spans`` cuts between two characters that no piece of a vocabulary has side by side, so that
no merge ever joins them.  Spans are hashed in slices of bounded size.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np

from .textnp import _BASE, _BASE_INV, _BYTE_CODE, mix

SLICE = 1 << 18
#: Spans above this many bytes are hashed one by one.
LONG_SPAN = 1 << 16

LETTER, NUMBER, OTHER, SPACE, UNSTABLE, UNKNOWN = range(6)
#: Endings that the pattern cuts off behind an apostrophe (fixed values).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: White space outside categories Z (fixed values).
CONTROL_SPACES = "\t\n\x0b\x0c\r\x85"


def _kind(char: str, category: str) -> int:
    if category[0] == "Z" or char in CONTROL_SPACES:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)


class CharacterClasses:
    """Class of code points, filled in as they occur.  A character that has changed its class since
    Unicode 3.2, or that is not assigned yet, is unstable: libraries may differ about it."""

    def __init__(self):
        self.table = np.full(0x110000, UNKNOWN, np.uint8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        new = out == UNKNOWN
        if new.any():
            for p in np.unique(points[new]).tolist():
                char = chr(p)
                now = unicodedata.category(char)
                kind = _kind(char, now)
                self.table[p] = kind if now != "Cn" and kind == _kind(char, unicodedata.ucd_3_2_0.category(char)) else UNSTABLE
            out = self.table[points]
        return out


def rows_with(data: np.ndarray, offs: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """Which rows may contain one of the strings."""
    raw, out = data.tobytes(), np.zeros(len(offs) - 1, bool)
    for s in strings:
        at = raw.find(s)
        while at >= 0:
            out[np.searchsorted(offs, at, side="right") - 1] = True
            at = raw.find(s, at + 1)
    return out


def pre_tokens(data: np.ndarray, offs: np.ndarray, classes: CharacterClasses, whole: np.ndarray | None = None) -> np.ndarray:
    """Byte positions where the rows' pre-tokens start.  Rows marked in ``whole``, and rows with
    unstable characters, are one span each."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of the characters
    points = data if len(at) == n else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = classes(points)
    size = len(at)
    full = np.diff(offs) > 0
    head = np.searchsorted(at, offs[:-1][full])  # rows' first characters
    first = np.zeros(size + 1, bool)
    first[head] = True
    first[size] = True
    space = kind == SPACE
    before = np.empty(size, np.uint8)
    before[0] = SPACE
    before[1:] = kind[:-1]
    start = ~space & (kind != before)  # a class begins
    blank = np.zeros(size, bool)
    blank[1:] = points[:-1] == 32
    start &= ~blank  # the space before belongs to it
    start |= space & ~np.append(False, space[:-1])  # white space begins
    # the last of several white-space characters before something else stands alone or goes with it
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:size]
    start[head] = True
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        row_end = np.flatnonzero(first[1:]) + 1  # end of every character's row, by order
        limit = row_end[np.searchsorted(row_end, quote, side="right")]
        for ending in ENDINGS:
            k = len(ending)
            hit = quote + k < limit
            for j, char in enumerate(ending):
                hit &= points[np.minimum(quote + 1 + j, size - 1)] == ord(char)
            found = quote[hit]
            start[found + 1] = False
            after = found + k + 1
            after = after[after < size]
            # what follows a cut-off ending starts anew; white space has its own rule
            start[after[~space[after]]] = True
            quote, limit = quote[~hit], limit[~hit]
    odd = np.zeros(len(offs) - 1, bool) if whole is None else whole.copy()
    unstable = kind == UNSTABLE
    if unstable.any():
        odd[np.searchsorted(offs, at[np.flatnonzero(unstable)], side="right") - 1] = True
    for r in np.flatnonzero(odd & full):
        lo, hi = np.searchsorted(at, offs[r:r + 2])
        start[lo + 1:hi] = False
    return at[start]


def joined_pairs(pieces: list[str], space: str) -> np.ndarray:
    """Table of the neighbouring characters that some piece joins, by byte, with one entry (128) for
    all characters outside ASCII."""
    out = np.zeros((129, 129), bool)
    out[128, 128] = True
    for p in pieces:
        codes = [min(ord(c), 128) for c in p.replace(space, " ")]
        for x, y in zip(codes, codes[1:]):
            out[x, y] = True
    return out


def bigram_spans(data: np.ndarray, offs: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Byte positions where spans start: rows' starts and places that no piece joins."""
    code = np.minimum(data, 128)
    start = np.ones(len(data), bool)
    start[1:] = ~joined[code[:-1], code[1:]]
    start[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(start)


def _slice_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64 for one slice."""
    if not _UP:
        for base in (_BASE, _BASE_INV):
            p = np.full(SLICE + 1, base, np.uint64)
            p[0] = 1
            _UP.append(np.multiply.accumulate(p))
    return _UP[0], _UP[1]


_UP: list[np.ndarray] = []


def span_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hash of every span, from its start to the next one's (equal bytes, equal hash)."""
    end = np.append(start[1:], len(data))
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        begin = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(end, begin + SLICE, side="right")))
        if end[lo] - begin > LONG_SPAN:
            out[lo] = span_hash(data[begin:end[lo]].tobytes())
            lo += 1
            continue
        part = data[begin:end[hi - 1]]
        up, down = _slice_powers()
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[part] * up[:len(part)], out=total[1:])
        a, b = start[lo:hi] - begin, end[lo:hi] - begin
        h = mix((total[b] - total[a]) * down[a] ^ (b - a).astype(np.uint64))
        for k in np.flatnonzero(b - a > LONG_SPAN):
            h[k] = span_hash(part[a[k]:b[k]].tobytes())
        out[lo:hi] = h
        lo = hi
    return out


def span_hash(raw: bytes) -> int:
    """The hash of one span."""
    if len(raw) > LONG_SPAN:
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return int(span_hashes(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64))[0])


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of per-span values over the rows; ``first`` has every row's first span and the end."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


class KnownSpans:
    """Numbers of hashes that have been met, in sorted arrays."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for a new one."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.numbers[at], np.int32(-1))

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """``keys`` ascending and new."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.numbers = np.insert(self.keys, at, keys), np.insert(self.numbers, at, numbers)
