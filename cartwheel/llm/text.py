"""Columns of text as byte arrays: words, rolling hashes and bounded slices of Arrow batches.

The functions work on whole texts.  Memory follows the longest single text: a batch is cut between rows into slices of
about ``SLICE`` bytes before any array is built.  Rows reach a task in batches of about ``BATCH`` bytes, and what a task has
freed goes back to the system when it ends, since its worker stays.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE = 1 << 20
#: of rows on their way to a worker: the executor and the worker each hold a few of these
BATCH = 4 << 20
#: bytes hashed at a time, so that the arrays for it stay small
CHUNK = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93 | 1)
#: bytes with A-Z turned to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true inside the ranges (both ends included)."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first:last + 1] = True
    return table


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (one entry more than rows); null: empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def per_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch], text: str, size: int = SLICE):
    """A function for ``mapInArrow`` that applies ``work`` to bounded slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, size):
            yield work(part)
    return run


def mapped(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` with bounded batches (a setting the session keeps); the worker keeps no freed memory."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return rows.mapInArrow(lean(run), schema)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function; when a task ends, the memory it has freed goes back to the system."""
    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return lean_run


def give_back() -> None:
    """Hands freed memory of Arrow and (on Linux) of the process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * CHUNK)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, factor in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range; equal bytes get equal hashes wherever they stand.  Starts are in order."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(starts, low + CHUNK)))
        out[at:upto] = _hashes(data[low:ends[at:upto].max()], starts[at:upto] - low, ends[at:upto] - low)
        at = upto
    return out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _weights(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes flagged ``inside``, cut at row ends, and the first word of each row
    (one entry more than rows)."""
    flags = inside[data]
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1]
    last[:-1] &= ~flags[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = flags[edges]
    last[edges - 1] = flags[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` consecutive hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = hashes[:len(hashes) - n + 1].copy()
    for i in range(1, n):
        total *= _STEP
        total += hashes[i:len(hashes) - n + 1 + i]
    return mix(total + np.uint64(n))
