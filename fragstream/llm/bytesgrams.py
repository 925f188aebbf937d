"""Vectorised words and n-grams over the UTF-8 bytes of Arrow string columns (numpy, no loop over words)."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True
_RNG = np.random.default_rng(20240229)
TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LONGEST = 64  # bytes of a word with a power of its own; longer words are hashed in parts
POWERS = np.array([pow(int(P), i, 2**64) for i in range(LONGEST)], np.uint64)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A partition function after which its worker, which Spark keeps, holds no more than it needs.

    Arrays from four megabytes up get pages of their own, which go back to the
    system when they are freed; what is left over at the end is given back.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        system = ctypes.CDLL(None)
        if hasattr(system, "mallopt"):
            system.mallopt(-3, 1 << 22)  # M_MMAP_THRESHOLD
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(system, "malloc_trim"):
            system.malloc_trim(0)

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, most: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, bytes, offsets) of runs of rows with about ``most`` bytes; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = lambda t: np.frombuffer(t.buffers()[1], width)[t.offset : t.offset + n + 1].astype(np.int64)
    found = off(texts)
    if texts.null_count and np.diff(found)[np.asarray(texts.is_null())].any():  # a null may hide bytes
        texts = texts.fill_null("")
        found = off(texts)
    data, off = texts.buffers()[2], found
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes that ``inside`` marks, never across rows."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    first = off[:-1]
    before[first[first < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    last = off[1:] - 1
    after[last[(last >= 0) & (off[1:] > off[:-1])]] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    total = int(size.sum())
    first = np.cumsum(size) - size
    at = np.arange(total) - np.repeat(first, size)
    value = TABLE[data[np.repeat(start, size) + at]]
    part = at // LONGEST
    value = value * POWERS[at % LONGEST]
    if part.any():
        value = mix(value + part.astype(np.uint64) * P) * (part > 0) + value * (part == 0)
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * P)


def prefixes(data: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word) of the first n bytes of each word that is longer."""
    at = np.flatnonzero(end - start > n)
    h = np.full(len(at), POWERS[n + 1])
    for j in range(n):
        h += TABLE[data[start[at] + j]] * POWERS[j]
    return mix(h), at
