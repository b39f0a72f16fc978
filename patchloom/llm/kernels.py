"""Vectorised text kernels for Arrow batches: word hashes and window hashes.

All work on the UTF-8 bytes of a batch of texts at once.  Temporary arrays
are bounded by ``CHUNK`` bytes of text, however long a document is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
U64 = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
WINDOW_BASE = U64(0xD1B54A32D192ED03)


def release() -> None:
    """Give freed memory back to the system at a task's end, as Spark keeps its Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    def __init__(self) -> None:
        self.pow = self.inv = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.pow):
            self.pow, self.inv = _powers(BASE, n), _powers(BASE_INVERSE, n)
        return self.pow, self.inv


TABLES = _Tables()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def doc_chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes each, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def word_spans(norm: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-zero bytes, cut at row offsets, and the n + 1 word offsets of rows."""
    n = len(norm)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    is_word = norm != 0
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    cuts = offsets[:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = is_word[cuts]
    last[cuts - 1] = is_word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(norm: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    w = 0
    while w < len(starts):
        lo = starts[w]
        to = max(int(np.searchsorted(starts, lo + CHUNK)), w + 1)
        hi = ends[to - 1]
        power, inverse = TABLES.upto(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(BYTE_HASH[norm[lo:hi]] * power[: hi - lo], out=sums[1:])
        s, e = starts[w:to] - lo, ends[w:to] - lo
        out[w:to] = (sums[e] - sums[s]) * inverse[s]
        w = to
    return mix(out)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive words; len(words) - k + 1 values."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= WINDOW_BASE
        acc += words[j : j + n]
    return mix(acc)


def within_rows(word_offsets: np.ndarray, k: int, n: int) -> np.ndarray:
    """True for the first ``n`` word positions whose window of k words stays in its row."""
    ok = np.ones(n, bool)
    for back in range(1, k):
        at = word_offsets[1:-1] - back
        ok[at[(at >= 0) & (at < n)]] = False
    return ok
