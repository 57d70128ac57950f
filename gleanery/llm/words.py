"""Words of UTF-8 texts as arrays: positions and 64-bit hashes, a whole Arrow batch at a time.

A word is a maximal run of bytes that are not white space (0x20, 0x09-0x0D), so
UTF-8 sequences are never cut. A word's hash is a sum of random byte values times
powers of an odd number, modulo 2^64, freed of the word's place and mixed.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Texts are taken in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18

_RANDOM = np.random.default_rng(20240817)
_BYTE_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 2**64)
_powers = {BASE: np.ones(1, dtype=np.uint64), INVERSE: np.ones(1, dtype=np.uint64)}


def powers_of(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 2**64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release() -> None:
    """Give freed memory back to the system: Spark uses its Python workers again, and two of them stand beside each JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows at most, so that what a function holds for a batch is bounded."""
    release()  # what the tasks before have left
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of slices of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


def word_bounds(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in ``data``, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers_of(BASE, len(data)), out=sums[1:])
    placed = (sums[ends] - sums[starts]) * powers_of(INVERSE, len(data) + 1)[starts]
    return mix(placed + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (none if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = (out + words[i : i + len(out)]) * np.uint64(BASE)
        out ^= out >> np.uint64(29)
    return mix(out)
