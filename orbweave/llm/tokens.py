"""Vectorised word hashing over Arrow string columns (numpy inside Spark tasks).

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR; the
letters A-Z are lower-cased, every other byte is kept. A word is represented by
a 64-bit hash of its bytes: two words meet with probability 2**-64 a pair.
A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multiplier of the polynomial, and the finaliser's constants.
_BASE = 0x9E3779B97F4A7C15
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_LEN = np.uint64(0xD6E8FEB86659FD93)

#: Bytes of text hashed at a time; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20

_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VAL = np.arange(1, 257, dtype=np.uint64)
_VAL[65:91] += np.uint64(32)
_POW = np.ones(1 << 12, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POW
    if _POW.size < n:
        _POW = np.full(1 << (n - 1).bit_length(), _BASE, np.uint64)
        _POW[0] = 1
        np.multiply.accumulate(_POW, out=_POW)
    return _POW


_POW = np.ones(1, np.uint64)
_powers(1 << 12)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets from 0) of a string array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32) if len(col) else np.zeros(1, np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2] if len(col) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def separators(extra: bytes = b"") -> np.ndarray:
    """Table of the bytes that end a word: white space and ``extra``."""
    table = _SEP.copy()
    table[list(extra)] = True
    return table


def word_spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of the words of a block of documents."""
    if not data.size:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~sep[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    first[heads] = word[heads]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = heads[1:] - 1
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are in order and don't overlap."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    lo, hi = starts[0], ends[-1]
    begin = starts - lo
    span = np.diff(np.append(begin, hi - lo))
    pos = np.arange(hi - lo, dtype=np.int64) - np.repeat(begin, span)
    value = _VAL[data[lo:hi]]
    value *= _powers(int(span.max()))[pos]
    value[pos >= np.repeat(ends - starts, span)] = 0
    return mix(np.add.reduceat(value, begin) + (ends - starts).astype(np.uint64) * _LEN)


class Block:
    """The words of documents [lo, hi) of a batch, in order."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lo: int, hi: int, sep: np.ndarray = _SEP):
        self.lo, self.hi = lo, hi
        self.data = data[off[lo]:off[hi]]
        self.off = off[lo:hi + 1] - off[lo]
        self.starts, self.ends, self.doc = word_spans(self.data, self.off, sep)
        self.hash = word_hashes(self.data, self.starts, self.ends)
        #: Words of document i are [first[i], first[i + 1]).
        self.first = np.searchsorted(self.doc, np.arange(hi - lo + 1))
        self.count = np.diff(self.first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, document) of each run of n words inside a document."""
        m = self.hash.size - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        inside = self.doc[:m] == self.doc[n - 1:]
        return gram_hashes(self.hash, n)[inside], self.doc[:m][inside]


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n successive word hashes."""
    m = h.size - n + 1
    out = h[:m].copy()
    for i in range(1, n):
        out *= np.uint64(_BASE)
        out += h[i:i + m]
    return mix(out)


def blocks(col: pa.Array, limit: int = BLOCK_BYTES, sep: np.ndarray = _SEP) -> Iterator[Block]:
    """Split a batch of texts into blocks of at most ``limit`` bytes (or one document)."""
    data, off = text_bytes(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield Block(data, off, lo, hi, sep)
        lo = hi
