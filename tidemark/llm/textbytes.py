"""Vectorised primitives over the raw UTF-8 bytes of a text column.

Python workers receive Arrow batches; these helpers look at the string buffer as one
``uint8`` array so that finding words, hashing spans and grouping them cost a few
nanoseconds a byte and never create a Python object per word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once: large enough to amortise numpy calls, small enough for the cache.
CHUNK = 1 << 20

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_libc = ctypes.CDLL(None)  # where it has no malloc_trim, nothing is given back

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = np.atleast_1d(np.asarray(x, _U))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    got = _powers.get(name)
    if got is None or len(got) < n:
        got = np.full(max(n, 2 * CHUNK), base, _U)
        got[0] = 1
        _powers[name] = got = np.cumprod(got, dtype=_U)
    return got[:n]


class Spans:
    """Hashes of any spans of ``data`` in constant time each (polynomial, modulo 2**64).

    ``table``: a random value for each symbol; bytes by default.
    """

    def __init__(self, data: np.ndarray, table: np.ndarray = _BYTE):
        n = len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(table[data] * _power("up", _BASE, n), out=self.sums[1:])
        self.inverse = _power("down", _BASE_INV, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(_U))


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    offs = np.frombuffer(offsets, wide)[array.offset : array.offset + len(array) + 1].astype(np.int64) if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(array) else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def release() -> None:
    """Gives freed memory back to the system: workers are reused, and an idle one should be small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc, "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batches, text: str = "text", size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``size`` text bytes (one longer text is a slice of its own)."""
    for batch in batches:
        data, offs = column(batch.column(text))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
            yield batch.slice(at, upto - at), data[offs[at] : offs[upto]], offs[at : upto + 1] - offs[at]
            at = upto
    release()


def words(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; words end at white space and at row ends."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(offs, s, "right") - 1


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of weights, by row."""
    out = np.bincount(rows, weights, n)
    return out if weights is None else np.rint(out).astype(np.int64)


def within(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One key for (row, key)."""
    return mix(keys + mix(rows.astype(_U) + _U(1)))
