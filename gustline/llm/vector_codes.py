"""Vector codes from exact whole-number codebooks, assigned through tries of distinct parts (operator 11).

Every vector becomes whole numbers floor(scale * entry), cut into equal consecutive parts. A task sorts the parts at each
position of a run of rows and keeps the distinct ones as a lexicographic trie: per leaf the number of leading numbers it shares
with the leaf before, the numbers that follow, and how many rows hold it. The tries are stored once; no row is shuffled.
Each round walks every trie depth first, in stretches of leaves: the distances to all entries that a common prefix has
gathered are worked out once and handed down, the open path goes on from one stretch to the next, and the leaves take the
nearest entry and add their numbers to it, as often as rows hold them. Per round one row per task, part and entry is shuffled, and the new
codebooks come to the driver: their size is parts x entries x numbers, whatever the data. All sums are whole numbers.

Defined results: vectors that are null or hold null or non-finite entries, or have another length than the most frequent one that
is a multiple of the number of parts, give no row; with fewer rows than entries a codebook has as many entries as rows; equal ids
are put in order of their vectors, null ids come last; repeated rows give rows each; null labels are one label; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.vectors import runs, whole, width
from gustline.session import write_stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
RUN_ROWS, STRETCH = 65_536, 4096
TRIE = "part int, dims int, kind string, shared binary, numbers binary, held binary"


def trie(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Leaves in lexicographic order: numbers shared with the leaf before, all following numbers end to end, rows per leaf, leaf of each row."""
    order = np.lexsort(parts.T[::-1])
    rows = parts[order]
    differs = rows[1:] != rows[:-1]
    first = np.concatenate([[True], differs.any(axis=1)])
    shared = np.concatenate([[0], differs.argmax(axis=1)])[first].astype(np.uint8 if parts.shape[1] < 256 else np.int64)
    leaf = np.empty(len(parts), np.int64)
    leaf[order] = np.cumsum(first) - 1
    numbers = rows[first][np.arange(parts.shape[1]) >= shared[:, None]]
    return shared, numbers, np.diff(np.append(np.flatnonzero(first), len(parts))), leaf


def leaves(shared: np.ndarray, numbers: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First leaf, numbers and distances to all entries of stretch after stretch of leaves, in depth-first order.

    A node is a prefix; its vector of distances is its parent's plus one squared difference per entry.
    """
    dims = entries.shape[1]
    begin = np.concatenate([[0], np.cumsum(dims - shared.astype(np.int64))])
    kind = entries.dtype
    path = [np.zeros(len(entries), kind) for _ in range(dims + 1)]
    point = np.zeros(dims, kind)
    for low in range(0, len(shared), STRETCH):
        own = shared[low : low + STRETCH].astype(np.int64)
        above, node = path[0][None, :], np.zeros(len(own), np.int64)
        values = np.empty((len(own), dims), kind)
        for d in range(dims):
            opens = own <= d
            at = np.flatnonzero(opens)
            number = numbers[begin[low + at] + d - own[at]].astype(kind)
            nodes = above[node[at]] + (number[:, None] - entries[:, d]) ** 2
            if not opens[0]:  # the path of the stretch before goes on
                nodes, number = np.concatenate([path[d + 1][None, :], nodes]), np.append(point[d], number)
            node = np.cumsum(opens) - (1 if opens[0] else 0)
            values[:, d] = number[node]
            above, path[d + 1], point[d] = nodes, nodes[-1], number[-1]
        yield low, values, above[node]


def exact(entries: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The entries as 64-bit numbers, or as Python numbers where squared distances might not fit."""
    most = max(int(np.abs(a).max()) if a.size else 0 for a in (entries, numbers))
    return entries.astype(np.int64 if 4 * most * most * max(1, entries.shape[1]) < 1 << 62 else object)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lower index of ties) of each row and its squared distance."""
    shared, numbers, _, leaf = trie(parts)
    entries = exact(entries, parts)
    codes, far = np.empty(len(shared), np.int64), np.empty(len(shared), entries.dtype)
    for low, _, distances in leaves(shared, numbers, entries):
        best = distances.argmin(axis=1)
        codes[low : low + len(best)], far[low : low + len(best)] = best, distances[np.arange(len(best)), best]
    return codes[leaf], far[leaf]


def tries(rows: DataFrame, vector: str, dims: int, parts: int, scale: int) -> DataFrame:
    """The stored tries of all runs of rows."""
    size = dims // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in runs(batches, dims, scale, RUN_ROWS):
            for p in range(parts):
                shared, numbers, held, _ = trie(x[:, p * size : (p + 1) * size])
                kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= numbers.min() and numbers.max() <= np.iinfo(k).max)
                yield pa.RecordBatch.from_pylist([{
                    "part": p, "dims": size, "kind": kind, "shared": shared.astype("<i8" if size > 255 else "u1").tobytes(),
                    "numbers": numbers.astype(kind).tobytes(), "held": held.astype("<i4").tobytes()}], schema=schema)

    schema = pa.schema([("part", pa.int32()), ("dims", pa.int32()), ("kind", pa.string()), ("shared", pa.binary()), ("numbers", pa.binary()), ("held", pa.binary())])
    return rows.sparkSession.read.schema(TRIE).parquet(write_stage(rows.select(vector).mapInArrow(run, TRIE), "tries"))


def moved(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every entry the floored mean of the parts nearest to it, or as before without any."""
    count, size = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                part, dims, kind, shared, numbers, held = (batch.column(i)[row].as_py() for i in range(6))
                shared = np.frombuffer(shared, "<i8" if dims > 255 else "u1")
                numbers, held = np.frombuffer(numbers, kind), np.frombuffer(held, "<i4").astype(np.int64)
                own = sums.setdefault(part, np.zeros((count, size + 1), object))
                for low, values, distances in leaves(shared, numbers, exact(books[part], numbers)):
                    code, times = distances.argmin(axis=1), held[low : low + len(values)]
                    # a stretch of a run has at most RUN_ROWS rows: below 2^47 a number, the sums fit 64 bits
                    kind_ = np.int64 if not len(values) or np.abs(values).max() < 1 << 46 else object
                    add = np.zeros((count, size + 1), kind_)
                    np.add.at(add, code, np.column_stack([values.astype(kind_), np.ones(len(values), kind_)]) * times[:, None])
                    own += add
        if sums:
            at = [(p, e) for p in sums for e in range(count) if sums[p][e, -1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in at], pa.int32()), pa.array([e for _, e in at], pa.int32()),
                pa.array([[int(v) for v in sums[p][e]] for p, e in at], pa.list_(pa.int64()))], ["part", "entry", "sums"])

    parts = stored.mapInArrow(run, "part int, entry int, sums array<bigint>")
    totals = parts.groupBy("part", "entry").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(size + 1)]).alias("sums"))
    out = books.copy()
    for row in totals.collect():  # one row per part and entry
        out[row.part, row.entry] = [s // row.sums[-1] for s in row.sums[:-1]]
    return out


def codebooks(rows: DataFrame, vector: str, key: str, dims: int, parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """(parts, entries, numbers) after all rounds, started from the vectors of the smallest keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole(batch.column(1), dims, scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(x.tolist(), pa.list_(pa.int64()))], [key, "x"])

    kind = rows.schema[key].dataType.simpleString()
    first = rows.select(key, vector).mapInArrow(run, f"`{key}` {kind}, x array<bigint>").orderBy(F.col(f"`{key}`").asc_nulls_last(), "x").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, dims // parts), np.int64)
    books = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1).swapaxes(0, 1)
    stored = tries(rows, vector, dims, parts, scale)
    for _ in range(rounds):
        books = moved(stored, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(rows: DataFrame, vector: str, key: str, label: str, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(key, label, code, error) of every row with a whole vector."""
    parts, _, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole(batch.column(2), parts * size, scale)
            codes, error = np.zeros((len(x), parts), np.int64), 0
            for p in range(parts if len(x) else 0):
                codes[:, p], far = nearest(x[:, p * size : (p + 1) * size], books[p])
                error = error + far
            rows_ = pa.array(at)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(rows_), batch.column(1).take(rows_), pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()], pa.string()),
                pa.array([int(e) for e in error] if len(x) else [], pa.int64())], [key, label, "code", "error"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in (key, label)}
    return rows.select(key, label, vector).mapInArrow(run, f"`{key}` {kinds[key]}, `{label}` {kinds[label]}, code string, error long")


def vector_codes(rows: DataFrame, vector: str, key: str, label: str, parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row with a whole vector."""
    spark = rows.sparkSession
    dims = width(rows, vector, parts)
    books = codebooks(rows, vector, key, dims, parts, entries, rounds, scale) if dims else np.zeros((parts, 0, 0), np.int64)
    kind = rows.schema[key].dataType.simpleString()
    if not books.size:
        return spark.createDataFrame([], f"`{key}` {kind}, code string, error long, label_error long, codebooks_sha256 string")
    plain = coded(rows, vector, key, label, books, scale)
    done = spark.read.schema(plain.schema).parquet(write_stage(plain, "codes"))
    sums = done.groupBy(F.col(f"`{label}`").alias("of_")).agg(F.sum("error").alias("label_error"))
    sums = spark.read.schema(sums.schema).parquet(write_stage(sums, "label-errors"))
    return done.join(sums, done[label].eqNullSafe(sums["of_"])).select(
        done[key], "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", "vec_id", "label")


def oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL: one step per round over (row, part) with the sixteen entries of each part."""
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
cell AS MATERIALIZED (SELECT r, (i - 1) // (n // {PARTS}) AS part, (i - 1) % (n // {PARTS}) AS place, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x AS e FROM cell WHERE r <= {ENTRIES})"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT r, part, arg_min(entry, far * 256 + entry) AS entry, min(far) AS far FROM (
  SELECT r, c.part, entry, CAST(sum((x - e) * (x - e)) AS BIGINT) AS far FROM cell c JOIN book{k} b ON b.part = c.part AND b.place = c.place
  GROUP BY r, c.part, entry) GROUP BY r, part)""")
        if k < rounds:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, CASE WHEN n IS NULL THEN e ELSE (s - ((s % n) + n) % n) // n END AS e FROM book{k} b
  LEFT JOIN (SELECT c.part, entry, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM cell c JOIN near{k} a ON a.r = c.r AND a.part = c.part
    GROUP BY c.part, entry, place) m ON m.part = b.part AND m.entry = b.entry AND m.place = b.place)""")
    return "WITH " + ",".join(steps) + f""",
rows_ AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM near{rounds} JOIN kept USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256 FROM rows_"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLE = {"op11_vector_codes": oracle()}
