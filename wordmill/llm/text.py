"""Words of whole texts as arrays, straight from Arrow buffers.

All functions work on slices of a record batch of bounded size, so memory in a
task follows ``SLICE_BYTES`` or the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Text bytes handled at once; a longer single text is taken alone.
SLICE_BYTES = 1 << 20
#: Bytes whose hash powers are kept; longer buffers are walked piece by piece.
POWER_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); same input, same output everywhere."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n - 1`` of the hash's multiplier and of its inverse."""
    return _powers(_MULT, n), _powers(_INV, n)


class Hasher:
    """Hash tables of one task (powers of the multiplier, a value per byte)."""

    def __init__(self):
        self.up, self.down = powers(POWER_BYTES)
        self.byte = mix(np.arange(1, 257, dtype=U64))

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of ``data[start[i]:end[i]]``; words do not overlap and are in order."""
        out = np.empty(len(start), dtype=U64)
        i = 0
        while i < len(start):
            lo = int(start[i])
            j = int(np.searchsorted(end, lo + POWER_BYTES, side="right"))
            if j <= i:  # a single word longer than the tables: fold it in pieces
                out[i] = self._long(data[lo : int(end[i])])
                i += 1
                continue
            part = data[lo : int(end[j - 1])]
            sums = np.empty(len(part) + 1, dtype=U64)
            sums[0] = 0
            np.cumsum(self.byte[part] * self.up[: len(part)], dtype=U64, out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = (sums[e] - sums[s]) * self.down[s]
            i = j
        return mix(out)

    def _long(self, word: np.ndarray) -> int:
        total, scale = 0, 1
        for k in range(0, len(word), POWER_BYTES):
            part = word[k : k + POWER_BYTES]
            total += scale * int(np.sum(self.byte[part] * self.up[: len(part)], dtype=U64))
            scale = scale * pow(_MULT, POWER_BYTES, 1 << 64) % (1 << 64)
        return total % (1 << 64)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[:128] = True
_MARK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


@dataclass
class Words:
    """Words of the texts of a slice.  Text ``d`` owns words ``first[d]:first[d + 1]``."""

    data: np.ndarray  # uint8, all texts one after another
    texts: np.ndarray  # byte offset of each text, one more than texts
    start: np.ndarray  # byte offsets of each word
    end: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.n)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; null is the empty text."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + len(col) + 1] if offs else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = (int(offs[0]), int(offs[-1])) if len(offs) else (0, 0)
    return offs - lo, raw[lo:hi]


def split_words(col: pa.Array, lower: bool = False, marks: bool = False) -> Words:
    """Words of each text: runs free of ASCII white space, or with ``marks`` of punctuation too.

    ``lower`` folds case first (Unicode).  With ``marks`` ASCII marks, the Latin-1
    marks U+00A0-00BF, general punctuation U+2000-206F and CJK marks U+3000-301F
    also end a word.
    """
    if lower:
        col = pc.utf8_lower(col.cast(pa.large_string()))
    texts, data = buffers(col)
    sep = (_MARK if marks else _SPACE)[data]
    if marks and len(data) > 2:
        two = (data[:-1] == 0xC2) & (data[1:] >= 0xA0) & (data[1:] <= 0xBF)
        three = ((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) | (
            (data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (data[2:] <= 0x9F)
        )
        for k in range(2):
            sep[k : len(sep) - 1 + k] |= two
        for k in range(3):
            sep[k : len(sep) - 2 + k] |= three
    word = ~sep
    begins = word.copy()
    begins[1:] &= sep[:-1]
    ends = word.copy()
    ends[:-1] &= sep[1:]
    inner = texts[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(data, texts, start, end, np.searchsorted(start, texts))


def grams(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text and the text of each.

    A text of 1 to ``size - 1`` words has one run of all its words; one without words has none.
    """
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(h))
    left = first[1:][doc] - at  # words from here to the end of the text
    take = (left >= size) | (at == first[:-1][doc])
    out = np.zeros(len(h), dtype=U64)
    for k in range(size):
        part = np.zeros(len(h), dtype=U64)
        part[: len(h) - k] = h[k:]
        out = out * U64(0x100000001B3) + np.where(left > k, part, U64(k + 1))
    return mix(out)[take], doc[take]


def slices(batches: Iterator[pa.RecordBatch], col: str, most: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that ``col`` holds about ``most`` bytes and ``rows`` rows at most, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        i = 0
        while i < len(size):
            done = ends[i - 1] if i else 0
            j = min(max(i + 1, int(np.searchsorted(ends, done + most, side="right"))), i + rows)
            yield batch.slice(i, j - i)
            i = j
