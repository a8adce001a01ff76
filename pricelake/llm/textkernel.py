"""Vectorised word scanning and hashing of a batch of UTF-8 texts in numpy.

A batch is one byte array plus document offsets, taken from the Arrow buffers
without a Python object per document or word.  Words and byte strings are
named by 64-bit polynomial hashes over randomised byte codes, finished with
the splitmix64 mixer; ``ASCII_FOLD`` makes the hash ignore the case of A-Z.
Work arrays are bounded: hashing runs in blocks of about ``BLOCK`` bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
_U = np.uint64
BASE = _U(0x9E3779B97F4A7C15)          # odd, so it has an inverse mod 2**64
INV_BASE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

ALNUM = np.zeros(256, bool)            # 0-9 A-Z a-z and every non-ASCII byte
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
NONSPACE = np.ones(256, bool)          # all but space and \t\n\v\f\r
NONSPACE[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    EXACT = mix((np.arange(256, dtype=np.uint64) + _U(1)) * BASE)
ASCII_FOLD = EXACT.copy()
ASCII_FOLD[65:91] = EXACT[97:123]

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (kept and grown on demand)."""
    if len(_POWERS[0]) < n:
        m = max(n, BLOCK + 1024)
        for k, b in enumerate((BASE, INV_BASE)):
            x = np.full(m, b, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x)
    return _POWERS[0], _POWERS[1]


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty.

    Called once per batch, so it also returns what earlier batches left in
    Arrow's pool to the system."""
    pa.default_memory_pool().release_unused()
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if pa.types.is_string(arr.type):
        arr = arr.cast(pa.binary())
    elif pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    wide = pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if off is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)
    off = off[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None \
        else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def doc_chunks(off: np.ndarray, limit: int = 1 << 20):
    """Ranges [a, b) of documents of about ``limit`` bytes each."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words(data: np.ndarray, off: np.ndarray, klass: np.ndarray):
    """Starts, ends (byte positions) and document index of every word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = klass[data]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = m[edge]
    last[edge - 1] = m[edge - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def string_hashes(data, starts, ends, codes=ASCII_FOLD) -> np.ndarray:
    """64-bit hashes of the byte strings [starts, ends), starts ascending."""
    out = np.empty(len(starts), np.uint64)
    a, n = 0, len(starts)
    with np.errstate(over="ignore"):
        while a < n:
            lo = int(starts[a])
            b = max(a + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
            b = min(b, n)
            hi = int(ends[a:b].max())
            p, inv = powers(hi - lo + 1)
            s = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(codes[data[lo:hi]] * p[:hi - lo], out=s[1:])
            i, j = starts[a:b] - lo, ends[a:b] - lo
            out[a:b] = mix((s[j] - s[i]) * inv[i]
                           + (j - i).astype(np.uint64) * BASE)
            a = b
    return out


def hash_of(word: str, codes=ASCII_FOLD) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return string_hashes(raw, np.array([0]), np.array([len(raw)]), codes)[0]
