"""Toxicity by a factorization machine over hashed terms (operator 2).

Terms are words without punctuation, in lower case, hashed to 2^18 buckets; a text is the set of its terms. The machine adds a weight
per term and, for each pair of terms of a text, the inner product of their factors, so it learns that an insult beside
a mention of a group weighs more than both alone. Every term of at least `LEAST` texts of the sample enters, whatever its own share
in the classes: a pair of terms that says nothing by each term alone is learned too. A first fit on all of them finds out which say
anything: weights are drawn to 0 by `ERRORS` standard errors of their gradient (L1), and all factors move by one common step and decay, so
that only directions along which pairs tell the classes apart grow. Terms left with a weight or with factors longer than `SHORT` are then
fitted on without that pull; the others, which would add up in long texts, weigh nothing.

The fit uses at most about `rows` labelled rows of each class, drawn by a hash of the id; weights restore the true shares of the classes. Whole
texts are scored in the tasks by sums of weights and factors.

Defined results: null and empty texts have no terms and get the score of the bias alone; repeated rows get equal scores; labels of unknown or null
ids and null labels are ignored; with labels of one class only the score is that class's share, without any it is 0; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.decontaminate import _BREAK, _LOWER
from gustline.llm.text import bounded_batches, slices, span_hashes, spans, utf8
from gustline.session import write_stage

BITS, ROWS, LEAST, FACTORS, EPOCHS = 18, 6000, 3, 8, 15
ERRORS, DECAY, STEP, SHORT, BATCH = 4.0, 1e-2, 0.5, 0.1, 256


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each word of each text."""
    data, bounds = utf8(column)
    starts, ends, rows = spans(data, bounds, _BREAK)
    return np.repeat(np.arange(len(column)), np.diff(rows)), (span_hashes(_LOWER[data], starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)


def descend(own: np.ndarray, row: np.ndarray, labels: np.ndarray, weights: np.ndarray, start: tuple, epochs: int, rng: np.random.Generator,
            pull: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, factors and bias after some epochs over texts with the terms `own` of text `row` (ascending).

    With a pull, weights are drawn to 0 by it and all factors take one common step; without, each entry has a step of its own."""
    w, v, b = start
    ends = np.searchsorted(row, np.arange(len(labels) + 1))
    sw, sv, sb, scale = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6, 1.0  # factors are v * scale
    if not len(w):
        return w, v, b
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            i = order[at : at + BATCH]
            term, place = np.unique(np.concatenate([own[ends[k] : ends[k + 1]] for k in i]), return_inverse=True)
            text = np.repeat(np.arange(len(i)), ends[i + 1] - ends[i])
            over = lambda at, x, n: np.stack([np.bincount(at, c, n) for c in x.T], 1)
            of = v[term] * scale
            q = over(text, of[place], len(i))
            raw = b + np.bincount(text, w[term][place], len(i)) + 0.5 * (q**2 - over(text, (of**2)[place], len(i))).sum(1)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[i]) * weights[i] / len(i)
            gw = np.bincount(place, g[text], len(term))
            gv = over(place, (g[:, None] * q)[text], len(term)) - gw[:, None] * of
            sw[term] += gw**2
            sb += g.sum() ** 2
            step = 0.3 / np.sqrt(sw[term])
            moved = w[term] - step * (gw + 1e-5 * w[term])
            if pull is None:
                w[term] = moved
                sv[term] += gv**2
                v[term] -= 0.05 * (gv + 1e-4 * of) / np.sqrt(sv[term])
            else:
                w[term] = np.sign(moved) * np.maximum(np.abs(moved) - step * pull[term], 0)
                scale *= 1 - STEP * DECAY
                v[term] = (of * (1 - STEP * DECAY) - STEP * gv / max(1.0, float(np.sqrt((gv**2).sum())))) / scale
            b -= 0.3 * g.sum() / np.sqrt(sb)
    return w, v * scale, float(b)


class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of <factors, factors>)."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 17):
        self.slot = np.full(1 << BITS, -1, np.int32)
        share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.0
        share_of = min(max(share, 1e-6), 1 - 1e-6)
        self.bias, self.weight, self.factor = float(np.log(share_of / (1 - share_of))), np.zeros(0), np.zeros((0, FACTORS))
        if not 0 < labels.sum() < len(labels):
            return
        bucket = np.concatenate(sets).astype(np.int64)
        used = np.flatnonzero(np.bincount(bucket, minlength=1 << BITS) >= LEAST)
        self.slot[used] = np.arange(len(used))
        own, row = self.slot[bucket], np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        row, own = row[own >= 0], own[own >= 0]
        ends = np.searchsorted(row, np.arange(len(sets) + 1))
        rng = np.random.default_rng(seed)
        weights = weights / weights.mean()
        w, v = np.zeros(len(used)), rng.normal(0, 0.01, (len(used), FACTORS))
        # the pull of a term: ERRORS standard errors of its mean gradient, given in the batches that hold the term
        spread = np.sqrt(np.bincount(own, (((share - labels) * weights) ** 2)[row], len(used)))
        pull = ERRORS * spread / len(sets) / np.minimum(1.0, BATCH * np.bincount(own, minlength=len(used)) / len(sets))
        w, v, b = descend(own, row, labels, weights, (w, v, self.bias), EPOCHS, rng, pull)
        told = np.flatnonzero((w != 0) | (np.sqrt((v**2).sum(1)) > SHORT))
        self.slot[used] = -1
        self.slot[used[told]] = np.arange(len(told))
        place = np.full(len(used), -1)
        place[told] = np.arange(len(told))
        own = place[own]
        row, own = row[own >= 0], own[own >= 0]
        w, v, b = descend(own, row, labels, weights, (w[told], v[told], b), 2 * EPOCHS, rng)
        self.bias, self.weight, self.factor = float(b), w, v

    def score(self, column: pa.Array) -> np.ndarray:
        row, bucket = terms(column)
        own = self.slot[bucket]
        pair = np.unique(row[own >= 0] << BITS | own[own >= 0])
        row, own = pair >> BITS, pair & ((1 << BITS) - 1)
        total = lambda x: np.bincount(row, x, len(column))
        raw = self.bias + total(self.weight[own])
        for k in range(FACTORS):
            of = self.factor[own, k].astype(float)
            raw += 0.5 * (total(of) ** 2 - total(of**2))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Machine:
    """The machine of the labelled rows of docs (doc_id, text), which must be training rows only."""
    spark = docs.sparkSession
    bounded_batches(spark)
    marks = labels.where("toxic in (0, 1)").select("doc_id", "toxic")
    count = {r["toxic"]: r["n"] for r in marks.where(~held_out()).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, F.lit(min(1.0, rows / max(1, count.get(1, 0))))).otherwise(F.lit(min(1.0, rows / max(1, count.get(0, 0)))))
    drawn = marks.where(~held_out()).where(F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(1_000_000)) < rate * 1_000_000)
    drawn = spark.read.parquet(write_stage(drawn, "drawn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, bucket = terms(part.column(part.schema.get_field_index("text")))
                at = np.searchsorted(row, np.arange(part.num_rows + 1))
                sets = [np.unique(bucket[a:b]).astype(np.int32).tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("toxic")), pa.array(sets, pa.binary())], ["toxic", "terms"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(drawn, "doc_id").select("toxic", "text")
    found = sorted((r["toxic"], bytes(r["terms"])) for r in texts.mapInArrow(run, "toxic int, terms binary").collect())
    y = np.array([t for t, _ in found], float)
    weights = np.array([count[t] / max(1.0, (y == t).sum()) for t in y])
    return Machine([np.frombuffer(s, np.int32) for _, s in found], y, weights)


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score = machine.score(part.column(part.schema.get_field_index("text")))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = plain.mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, fit(docs.where(~held_out()), labels))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}
