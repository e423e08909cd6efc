"""Vectorised text primitives shared by the operators of this subpackage.

A block of documents is handled as one byte buffer plus row offsets, the way
Arrow stores a string column, so no Python string is built per document.
Hashes are polynomial over the bytes modulo 2**64 (prefix sums make the hash
of any substring O(1)) and finished with a bit mixer.

Everything here runs inside Spark tasks on one bounded block at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text handled at a time (arrays of 8 bytes each fit a cache); a longer document is a block of its own.
BLOCK_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (kept and grown per process)."""
    if "p" not in _powers or len(_powers["p"]) < n:
        m = max(n, BLOCK_BYTES + (1 << 12))
        for key, base in (("p", int(BASE)), ("i", _inverse(int(BASE)))):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["p"][:n], _powers["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Prefix hash of a byte buffer; ``of(s, e)`` hashes substrings [s, e)."""

    def __init__(self, data: np.ndarray):
        self.pw, self.inv = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.pw[:-1], out=self.sums[1:])

    def of(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sums[e] - self.sums[s]) * self.inv[s] + (e - s).astype(np.uint64) * BASE)


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null row is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        width = np.int64
    else:
        col, width = col.cast(pa.string()), np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, width)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, max_bytes: int = BLOCK_BYTES):
    """Row ranges (i, j) whose texts take at most ``max_bytes`` (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_blocks(batch, column: str = "text", max_bytes: int = BLOCK_BYTES):
    """Yield (first row, end row, bytes, offsets) of the blocks of a record batch."""
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
    for i, j in row_blocks(offsets, max_bytes):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of maximal runs of ``mask``, cut at row borders."""
    n = len(mask)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start = mask.copy()
    start[1:] &= ~mask[:-1] | border[1:n]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | border[1:n]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.

    Returns (start, end, row, hash) with one entry per word.
    """
    s, e, row = runs(~_SPACE[data], offsets)
    return s, e, row, Prefix(_LOWER[data]).of(s, e)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words (``words``) of every row."""
    return counts_of(runs(~_SPACE[data], offsets)[2], len(offsets) - 1)


def counts_of(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the n-grams of consecutive words inside each row."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    acc = np.zeros(m, np.uint64)
    for j in range(n):
        acc = acc * BASE + h[j:j + m]
    ok = row[:m] == row[n - 1:]
    return mix(acc[ok]), row[:m][ok]
