"""Whitening of embeddings from a bit-sliced scatter matrix (operator 13).

Every vector becomes whole numbers x = floor(scale * entry). The distinct x are the fit list. Each task takes runs of
these, subtracts the least value of each dimension in the run, and packs bit p of dimension i over all rows of the run into 64-bit
words: one bit plane. The cross-product of two dimensions is the sum over their planes p and q of 2^(p+q) times the number
of ones in (plane AND plane), and the shifts are put back exactly. Tasks give exact sums of products as decimals;
n times these less the products of the sums are the centred numbers, still whole, and only then become doubles for the
eigenvectors of a dims x dims matrix on the driver.

Defined results: vectors that are null or hold null or non-finite entries, or have another length than the most
frequent one, give no row; repeated rows give rows each, but are one vector of the fit list; a component without
variance (fewer than two distinct vectors, say) has null `whitened`; an empty table gives no row; other columns are ignored, and a null id stays null.
Sums that fit no 64-bit (deviation) or 38-digit (products) number are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.vectors import whole
from gustline.llm.vectors import width as common_width
from gustline.session import write_stage

SCALE, COMPONENTS, RUN_ROWS = 256, 4, 16_384
NO_VARIANCE = 1e-12
OUT = "component int, n long, deviation long, whitened double, explained double"


def packed(x: np.ndarray) -> pa.Array:
    """Each row as bytes: its narrowest width (1, 2, 4 or 8), then its numbers; equal rows have equal bytes."""
    size = np.abs(x + (x < 0)).max(axis=1, initial=0)
    out = np.empty(len(x), object)
    kinds = np.searchsorted([1 << 7, 1 << 15, 1 << 31], size, side="right")
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        raw = x[at].astype(f"<i{1 << kind}").view(np.uint8).reshape(len(at), -1)
        rows = np.column_stack([np.full(len(at), 1 << kind, np.uint8), raw])
        out[at] = [r.tobytes() for r in rows]
    return pa.array(out, pa.binary())


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    out = np.empty((len(column), dims), np.int64)
    rows = column.to_pylist()
    kinds = np.array([r[0] for r in rows])
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        raw = np.frombuffer(b"".join(rows[i] for i in at), np.uint8).reshape(len(at), -1)[:, 1:]
        out[at] = np.ascontiguousarray(raw).view(f"<i{kind}")
    return out


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact cross-products of the columns (1, x), as Python numbers, from AND-popcounts of bit planes."""
    n, dims = x.shape
    low = x.min(axis=0)
    y = np.column_stack([np.ones(n, np.uint64), (x - low).astype(np.uint64)])
    bits = [max(1, int(top).bit_length()) for top in y.max(axis=0)]
    owner = np.repeat(np.arange(dims + 1), bits)
    place = np.concatenate([np.arange(b) for b in bits])
    words = -(-n // 64)
    planes = np.zeros((len(owner), words * 8), np.uint8)
    for p in range(max(bits)):
        at = np.flatnonzero(place == p)
        ones = np.packbits(((y[:, owner[at]] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=0)
        planes[at, : len(ones)] = ones.T
    planes = planes.view(np.uint64)
    # 2^(p+q) times the count: in 64 bits where that is sure to fit, in Python numbers otherwise
    kind = np.int64 if 2 * max(bits) + n.bit_length() < 62 else object
    weight = np.array([1 << int(p) for p in place], kind)
    edges = np.flatnonzero(place == 0)
    full = np.zeros((dims + 1, dims + 1), kind)
    for r, i in enumerate(owner):
        ones = np.bitwise_count(planes[r] & planes[r:]).sum(axis=1, dtype=np.int64)
        part = ones.astype(kind) * weight[r:] * weight[r]
        part[1 : edges[i] + bits[i] - r] *= 2  # other planes of the same dimension: p, q and q, p
        full[i, i:] += np.add.reduceat(part, np.maximum(edges[i:] - r, 0))
    full = full.astype(object)
    full = np.triu(full) + np.triu(full, 1).T
    shift = np.array([0, *map(int, low)], object)
    sums = full[0]
    return full + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)


@dataclass(frozen=True)
class Whitening:
    """Fitted map: (x - sums / n) times `vectors` over the roots of `values`."""

    dims: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x.astype(object) * self.n - np.array(self.sums, object) if self.wide(x) else x * self.n - np.array(self.sums, np.int64))
        flat = self.values <= NO_VARIANCE * self.trace
        return (z.astype(float) / self.n) @ self.vectors / np.where(flat, np.nan, np.sqrt(np.where(flat, 1.0, self.values)))

    def wide(self, x: np.ndarray) -> bool:
        """Whether sums of squares of n x - sums could leave 64 bits."""
        most = int(max(-int(x.min(initial=0)), int(x.max(initial=0)))) * self.n + max(map(abs, self.sums), default=0)
        return most * most * max(1, self.dims) >= 1 << 63

    def deviation(self, x: np.ndarray) -> np.ndarray:
        if self.wide(x):
            z = x.astype(object) * self.n - np.array(self.sums, object)
            return np.array([int(v) for v in (z * z).sum(axis=1)], object).astype(np.int64)
        z = x * self.n - np.array(self.sums, np.int64)
        return (z * z).sum(axis=1)


def fit_list(rows: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """The distinct x, one row of bytes each, stored. Copies within a batch go before the shuffle, so no hot vector travels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch.column(0), dims, scale)[1]
            yield pa.RecordBatch.from_arrays([packed(x).dictionary_encode().dictionary], ["x"])

    distinct = rows.select(vector).mapInArrow(run, "x binary").distinct()
    return rows.sparkSession.read.schema("x binary").parquet(write_stage(distinct, "fit-list"))


def blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    held: list[np.ndarray] = []
    for batch in batches:
        for low in range(0, batch.num_rows, RUN_ROWS):
            held.append(unpacked(batch.column(0).slice(low, RUN_ROWS), dims))
            if sum(map(len, held)) >= RUN_ROWS:
                yield np.concatenate(held)
                held = []
    if held:
        yield np.concatenate(held)


def products(listed: DataFrame, dims: int) -> np.ndarray:
    """Exact sums of products of (1, x) over the fit list; (dims + 1)^2 / 2 numbers come to the driver."""
    upper = np.triu_indices(dims + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for x in blocks(batches, dims):
            part = scatter(x)
            sums = part if sums is None else sums + part
        if sums is not None:
            cells = [Decimal(int(v)) for v in sums[upper]]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.decimal128(38, 0))], ["cell", "total"])

    cells = listed.mapInArrow(run, "cell int, total decimal(38,0)").groupBy("cell").agg(F.sum("total").alias("total"))
    flat = np.zeros(len(upper[0]), object)
    for row in cells.toLocalIterator():
        flat[row.cell] = int(row.total)
    out = np.zeros((dims + 1, dims + 1), object)
    out[upper] = flat
    return np.triu(out) + np.triu(out, 1).T


def fit(listed: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The first components of the fit list; None if it is empty."""
    sums = products(listed, dims)
    n = int(sums[0, 0])
    if not n:
        return None
    centred = n * sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:])
    covariance = np.array([[int(v) / (n * n) for v in row] for row in centred], float).reshape(dims, dims)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    fitted = Whitening(dims, n, tuple(map(int, sums[0, 1:])), values[order], vectors, float(np.trace(covariance)))
    return replace(fitted, identity_error=identity_error(listed, fitted))


def identity_error(listed: DataFrame, fitted: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the whitened rows."""
    keep = np.flatnonzero(fitted.values > NO_VARIANCE * fitted.trace)
    if not len(keep):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, line = np.zeros((len(keep), len(keep))), np.zeros(len(keep))
        for x in blocks(batches, fitted.dims):
            w = fitted.project(x)[:, keep]
            square, line = square + w.T @ w, line + w.sum(axis=0)
        cells = np.concatenate([square.ravel(), line])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "total"])

    cells = listed.mapInArrow(run, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    flat = np.zeros(len(keep) * (len(keep) + 1))
    for row in cells.collect():
        flat[row.cell] = row.total / fitted.n
    mean = flat[len(keep) ** 2 :]
    return float(np.abs(flat[: len(keep) ** 2].reshape(len(keep), -1) - np.outer(mean, mean) - np.eye(len(keep))).max())


def whitened(rows: DataFrame, vector: str, key: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every row with a whole vector."""
    kind = rows.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, {OUT}"
    dims = common_width(rows, vector)
    fitted = fit(fit_list(rows, vector, dims, scale), dims, components) if dims else None
    if fitted is None:
        return rows.sparkSession.createDataFrame([], f"{out}, identity_error double")
    explained = fitted.values / fitted.trace if fitted.trace > 0 else np.full(len(fitted.values), np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole(batch.column(1), dims, scale)
            k = len(fitted.values)
            w = fitted.project(x).ravel()
            share = np.tile(explained, len(at))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(w), fitted.n)), pa.array(np.repeat(fitted.deviation(x), k)),
                pa.array(w, mask=np.isnan(w)), pa.array(share, mask=np.isnan(share))],
                [key, "component", "n", "deviation", "whitened", "explained"])

    return rows.select(key, vector).mapInArrow(run, out).withColumn("identity_error", F.lit(fitted.identity_error).cast("double"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", "vec_id")


QUERIES = {"op13_whitening": op13_whitening}
ORACLE: dict[str, str] = {}
