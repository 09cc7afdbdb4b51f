"""Vectors of a batch as whole numbers, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def width(rows: DataFrame, vector: str, multiple: int = 1) -> int:
    """The most frequent length of the vectors (the longer one of ties) that is a multiple of `multiple`; 0 without any."""
    sizes = rows.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).count()
    best = sizes.where((F.col("size") > 0) & (F.col("size") % multiple == 0)).orderBy(F.desc("count"), F.desc("size")).first()
    return best["size"] if best else 0


def whole(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector has `dims` finite entries, and floor(scale * entry) of these as a matrix of int64.

    Rows with a null vector, a null or non-finite entry or another length are left out. An entry whose multiple does not
    fit 64 bits is an error, not a wrong number.
    """
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dims)
    good = np.isfinite(values).all(axis=1)
    scaled = np.floor(values[good] * scale)
    if scaled.size and not np.abs(scaled).max() < 2.0 ** 63:
        raise OverflowError("a vector component does not fit 64 bits")
    return rows[good], scaled.astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch], dims: int, scale: int, most: int) -> Iterator[np.ndarray]:
    """Matrices of at least one and about `most` vectors, from the first column of all batches of a task."""
    held: list[np.ndarray] = []
    for batch in batches:
        for low in range(0, batch.num_rows, most):
            held.append(whole(batch.column(0).slice(low, most), dims, scale)[1])
            if sum(map(len, held)) >= most:
                yield np.concatenate(held)
                held = []
    if sum(map(len, held)):
        yield np.concatenate(held)

