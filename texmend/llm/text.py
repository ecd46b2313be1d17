"""Words, hashes and ranges over whole Arrow batches, in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa

#: The classes of the contracts: white space is \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Lower-cases A-Z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII other than letters and digits.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]

M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    up[1:], down[1:] = BASE, np.uint64(BASE_INV)
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i in 0..n."""
    up, down = _powers(max(16, int(n).bit_length()))
    return up[: n + 1], down[: n + 1]


class RangeHash:
    """64-bit polynomial hashes of any byte range of a buffer; equal ranges have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray):
        self.up, down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * down[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.up[starts] + (ends - starts).astype(np.uint64))


def lean(function: Callable) -> Callable:
    """function on batches, whose worker gives its freed memory back when a task ends: workers wait for further tasks."""

    @wraps(function)
    def run(*args):
        try:
            yield from function(*args)
        finally:
            _powers.cache_clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and the n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not data:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most `limit` bytes of text, or one row if that is longer."""
    data, at = utf8(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row), data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def word_bounds(data: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes outside gap, never across rows), and for each row the number of words before it (n + 1)."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(gap[data], out=inside[1:-1])
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
    ends = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def row_sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places some range covers."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def windows_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows of a run of word hashes (rows not minded)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += mix(words[j : j + n] + np.uint64((BASE * (2 * j + 1)) & M64)) * np.uint64((BASE_INV * (2 * j + 3)) & M64 | 1)
    return mix(out)


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)
