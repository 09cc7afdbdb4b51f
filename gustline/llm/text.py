"""Words, windows and lines of whole columns of texts as numpy arrays.

The functions take an Arrow column of one batch and work on its UTF-8 bytes, so a batch costs a few passes over its
bytes and no Python object per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
SLICE_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for an executor's Python workers, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    except Exception:  # older Spark has no limit by bytes
        return


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text; one longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, bounds = utf8(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the row bounds in them."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) or pa.types.is_null(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0]).astype(np.int64)


def spans(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (longest run of bytes outside `gap`), and the row bounds in words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    solid = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid
    end[:-1] &= gap[data[1:]] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value per byte, powers of the base and of its inverse modulo 2^64."""
    per_byte = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    size = SLICE_BYTES + 1
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    return per_byte, up, down


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each span of bytes; equal bytes have equal hashes at any place."""
    per_byte, up, down = _tables()
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + SLICE_BYTES, side="right")), at + 1)
        low, high = starts[at], ends[to - 1]
        if high - low > SLICE_BYTES:  # one span longer than the tables: fold its pieces
            h = np.uint64(0)
            for p in range(int(low), int(high), SLICE_BYTES):
                piece = per_byte[data[p : min(p + SLICE_BYTES, high)]]
                h = mix(np.array([h], np.uint64) * np.uint64(_BASE) + (piece * up[: len(piece)]).sum(dtype=np.uint64))[0]
            out[at] = h
        else:
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(per_byte[data[low:high]] * up[: high - low], out=sums[1:])
            out[at:to] = (sums[ends[at:to] - low] - sums[starts[at:to] - low]) * down[starts[at:to] - low]
        at = to
    return mix(out)


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of `size` words inside one row; the i-th window starts at word `first[i]`."""
    first, row = window_starts(rows, size)
    rolled = np.zeros(len(first), np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[first + k]
    return mix(rolled), row


def window_starts(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of every run of `size` words; rows are the row bounds in words."""
    counts = np.diff(rows)
    per_row = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), per_row)
    before = np.concatenate([[0], np.cumsum(per_row)[:-1]]) if len(per_row) else np.zeros(0, np.int64)
    return (np.arange(len(row)) - before[row] + rows[:-1][row]).astype(np.int64), row


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive bounds; empty rows sum to 0."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key is found twice or more. Keys alone in a hash bucket are settled without sorting."""
    out = np.zeros(len(keys), bool)
    if len(keys) < 2:
        return out
    bits = min(24, max(8, int(len(keys)).bit_length() + 2))
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(bucket, minlength=1 << bits)[bucket] > 1)
    if len(maybe):
        _, back, times = np.unique(keys[maybe], return_inverse=True, return_counts=True)
        out[maybe] = times[back] > 1
    return out
