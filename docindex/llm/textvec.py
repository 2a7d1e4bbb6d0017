"""Vectorised text scanning shared by the operators that run numpy inside tasks.

A task sees Arrow batches; ``chunks`` cuts a string column into pieces of at
most ``CHUNK_BYTES`` of text (one longer text is a piece of its own, never
split), so a worker's memory follows the longest text, not the batch.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10

WHITE = np.zeros(256, dtype=bool)
WHITE[[32, *range(9, 14)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_G = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) over an unsigned array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _G)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int):
    """base**i and base**-i modulo 2**64 for i < n, grown on demand."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _INV)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1]


def returning(run):
    """``run`` (a generator over Arrow batches) that gives its memory back to the system at its end.

    A Python worker lives on after its task, and the C library keeps what large arrays leave behind; without this, the
    workers of an executor hold on to the peak of every operator that they ever ran.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _powers[:] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def few(batches, rows: int = 256):
    """The batches in slices of a few rows: what a loop turns into Python objects at once is small, however long the rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def string_buffers(column: pa.Array):
    """(bytes, offsets) of a string array; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES):
    """Yield (first row, last row + 1, bytes, offsets from 0) pieces of a string column."""
    data, offsets = string_buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE):
    """Starts and ends of the maximal runs of other bytes, and each text's first word index (n + 1)."""
    keep = ~separators[buf]
    head = keep.copy()
    head[1:] &= ~keep[:-1]
    first = offsets[:-1][offsets[:-1] < len(buf)]
    head[first] = keep[first]
    tail = keep.copy()
    tail[:-1] &= ~keep[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    tail[last] = keep[last]
    starts = np.flatnonzero(head)
    return starts, np.flatnonzero(tail) + 1, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of every item, given each text's first item index (n + 1)."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal bytes give equal values wherever they stand."""
    power, inverse = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_CODE[buf] * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _G)


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each [offsets[i], offsets[i + 1])."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def duplicate_positions(keys: np.ndarray):
    """(later, any): flags of keys equal to an earlier one, and of keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, anywhere = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order[1:]] = same
    anywhere[order[1:]] = same
    anywhere[order[:-1][same]] = True
    return later, anywhere
