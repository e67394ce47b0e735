"""Whole texts as flat UTF-8 byte arrays, so that numpy works on a batch of documents at once.

Batches come from Spark as Arrow; a null text counts as an empty one here. ``slabs`` cuts a batch
into runs of documents of bounded size, so memory follows ``SLAB_BYTES`` and the longest single
document, not the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLAB_BYTES = 2 << 20

# White space of the word pattern [^\x20\x09-\x0D]+ : all of it ASCII, so bytes decide.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_KEYS = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slabs(offsets: np.ndarray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Runs (first row, row behind the last) of about ``limit`` bytes at most, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), rows)
        yield row, last
        row = last


def text_slabs(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLAB_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each slab's rows, bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        for a, b in slabs(offsets, limit):
            yield batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _ladder(base: int, steps: int) -> np.ndarray:
    return np.array([pow(base, k, 2**64) for k in range(steps)], np.uint64)


# Powers of the base up to SLAB_BYTES as products of two short ladders: these travel with tasks.
_STEP = 2048
_POWERS = _ladder(int(_BASE), _STEP), _ladder(pow(int(_BASE), _STEP, 2**64), SLAB_BYTES // _STEP + 1)
_INVERSES = _ladder(int(_BASE_INVERSE), _STEP), _ladder(pow(int(_BASE_INVERSE), _STEP, 2**64), SLAB_BYTES // _STEP + 1)


def _powers(length: int) -> np.ndarray:
    low, high = _POWERS
    return np.outer(high[:-(-length // _STEP)], low).ravel()[:length]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); spans ascend and don't overlap.

    A span's hash is the sum of its bytes' keys times powers of an odd base, taken from running
    sums, then scrambled; long inputs are worked off in pieces that end between spans, and a span
    beyond a piece is summed on its own.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + SLAB_BYTES, "right")), i + 1)
        stop = ends[j - 1]
        if stop - base > SLAB_BYTES:
            total = np.uint64(0)
            scale = np.uint64(1)
            with np.errstate(over="ignore"):
                for k in range(base, stop, SLAB_BYTES):
                    part = data[k:min(k + SLAB_BYTES, stop)]
                    total += scale * (_BYTE_KEYS[part] * _powers(len(part))).sum(dtype=np.uint64)
                    scale *= _POWERS[1][-1]
            out[i] = total
        else:
            piece = data[base:stop]
            sums = np.empty(len(piece) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE_KEYS[piece] * _powers(len(piece)), out=sums[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * _INVERSES[0][s % _STEP] * _INVERSES[1][s // _STEP]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each document's first word number (rows + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    stops = word
    stops[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def rows_of(firsts: np.ndarray) -> np.ndarray:
    """The row of each item, from every row's first item number."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def per_row_sum(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; empty rows give 0."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def keep_rows(
    docs: DataFrame, text: str, verdict: Callable[[np.ndarray, np.ndarray], np.ndarray], limit: int = SLAB_BYTES
) -> DataFrame:
    """The rows, with all their columns, whose texts ``verdict(bytes, offsets)`` approves; one
    pass, no shuffle."""
    at = docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for a, b in slabs(offsets, limit):
                good = verdict(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield batch.slice(a, b - a).filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte spans as an Arrow binary column, without a copy per row."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets.astype(np.int32))),
         pa.py_buffer(np.ascontiguousarray(data))],
    )
