"""Vectorised words, word hashes and window hashes over Arrow text columns.

A word is ``[^\\x20\\x09-\\x0D]+``, unchanged. All functions work on slices of a few MB so that the
temporary arrays stay small whatever the batch; one text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
PIECE = 1 << 16
U = np.uint64
_B, _C = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and its neighbours need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for i below ``PIECE`` (base is odd)."""
    if base not in _powers:
        up, down = np.full(PIECE, U(base)), np.full(PIECE, U(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[base]


def sums(x: np.ndarray, base: int) -> np.ndarray:
    """Sums of ``x[j] * base ** j`` over j below each place, modulo 2**64, a piece at a time so that little else is held."""
    out, up, scale = np.zeros(len(x) + 1, U), powers(base)[0], 1
    for a in range(0, len(x), PIECE):
        part = x[a : a + PIECE].astype(U) * up[: min(PIECE, len(x) - a)]
        part *= U(scale)
        np.cumsum(part, out=out[a + 1 : a + 1 + len(part)])
        out[a + 1 : a + 1 + len(part)] += out[a]
        scale = scale * pow(base, PIECE, 1 << 64) % (1 << 64)
    return out


def moved(x: np.ndarray, at: np.ndarray, base: int) -> np.ndarray:
    """``x * base ** -at``: sums from a place on, as if they began at 0."""
    down = powers(base)[1]
    step, most = pow(base, -PIECE, 1 << 64), int(at.max(initial=0)) // PIECE + 1
    high = np.multiply.accumulate(np.array([1, *[step] * (most - 1)], U))
    return x * down[at & (PIECE - 1)] * high[at // PIECE]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def no_nulls(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "") if column.null_count else column


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = no_nulls(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off.astype(np.int64) - int(off[0])


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word's index of each row (with the total at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, U)
    total = byte_sums(data)
    return mix(moved(total[ends] - total[starts], starts, _B) + (ends - starts).astype(U))


def byte_sums(data: np.ndarray) -> np.ndarray:
    """``sums`` of bytes, each more by one, so that zeros count."""
    return sums(data + np.uint16(1), _B)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive words (across rows too: the caller leaves those out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    total = sums(words, _C)
    return mix(moved(total[k:] - total[:-k], np.arange(n), _C), k)


def row_windows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First window's index and the number of windows of each row, in the array of ``window_hashes``."""
    return first[:-1], np.maximum(np.diff(first) - k + 1, 0)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + c)``."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    s, c = starts[keep].astype(np.int64), counts[keep]
    ends = np.cumsum(c)
    out[0] = s[0]
    out[ends[:-1]] = s[1:] - (s[:-1] + c[:-1] - 1)
    return np.cumsum(out)


def sliding_min(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of each window of w values and its position, the rightmost on ties."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, h.dtype), np.zeros(0, np.int64)
    value, at, width = h, np.arange(len(h), dtype=np.int32), 1
    while width < w:
        step = min(width, w - width)
        left, right = value[:-step], value[step:]
        take = right <= left
        value, at = np.where(take, right, left), np.where(take, at[step:], at[:-step])
        width += step
    return value, at


def binary(parts: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows are consecutive pieces of ``parts``."""
    off = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * parts.dtype.itemsize, out=off[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(parts))]).cast(pa.binary())
