"""Language identification by a string kernel (operator 8).

The blended-spectrum presence kernel of two texts is the number of n-grams of code points (n from 1 to 4, lower case, hashed to 2^13 bins)
that both hold, over the geometric mean of their own numbers. A Nystroem approximation represents texts by their kernel values
against landmarks; one-versus-rest kernel ridge regression on these gives a margin per language. Texts are scored
in batches: presence matrix x landmark matrix x coefficients.

The fit uses at most about `rows` rows with a language tag, evenly over the languages, drawn by a hash of the id.

Defined results: `und` with score 0 if the text is null or has no letter, or no language could be learned; ties go to the
first language by name; repeated rows agree; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import bounded_batches, mix, slices, utf8
from gustline.llm.toxicity import held_out
from gustline.session import write_stage

BITS, LONGEST, ROWS, LANDMARKS, RIDGE, BATCH = 13, 4, 4000, 256, 1e-3, 256
LETTER = regex.compile(r"\p{L}")


def presence(column: pa.Array) -> Iterator[np.ndarray]:
    """Presence matrices of hashed n-grams, BATCH rows each."""
    data, bounds = utf8(pc.utf8_lower(column.fill_null("")) if len(column) else column)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = leads[bounds]
    for low in range(0, len(column), BATCH):
        high = min(low + BATCH, len(column))
        own, edge = chars[at[low] : at[high]], at[low : high + 1] - at[low]
        row = np.repeat(np.arange(high - low), np.diff(edge))
        left = edge[1:][row] - np.arange(len(own))
        out = np.zeros((high - low) << BITS, np.float32)
        rolled = np.zeros(len(own), np.uint64)
        for n in range(1, LONGEST + 1):
            rolled = rolled[: len(own) - n + 1] * np.uint64(0x100000001B3) + own[n - 1 :] + np.uint64(1)
            if not len(rolled):
                break
            bins = (mix(rolled + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64) + (row[: len(rolled)] << BITS)
            out[bins[left[: len(rolled)] >= n]] = 1
        yield out.reshape(high - low, 1 << BITS)


class Classifier:
    """Nystroem kernel ridge regression over landmark presence vectors."""

    def __init__(self, found: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        pick = np.unique(np.linspace(0, len(langs) - 1, min(landmarks, len(langs))).astype(int))
        self.marks = self._unit(found[pick])
        kernel = self._unit(found) @ self.marks.T
        among = kernel[pick]
        wanted = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        share = (wanted > 0).mean(0)
        left = kernel.T.astype(float) @ kernel + ridge * len(langs) * among + 1e-6 * np.eye(len(pick))
        self.coef = np.linalg.solve(left, kernel.T @ (wanted - (2 * share - 1)))
        self.base = 2 * share - 1

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        langs, scores = [], []
        if self.langs:
            for x in presence(column):
                margin = (self._unit(x) @ self.marks.T) @ self.coef + self.base
                odds = np.exp(4 * (margin - margin.max(1, keepdims=True)))
                langs += [self.langs[i] for i in margin.argmax(1)]
                scores.append(odds.max(1) / odds.sum(1))
        else:
            langs, scores = ["und"] * len(column), [np.zeros(len(column))]
        scores = np.concatenate(scores) if scores else np.zeros(0)
        for i, text in enumerate(column.to_pylist()):
            if text is None or not LETTER.search(text):
                langs[i], scores[i] = "und", 0.0
        return langs, scores


def fit(docs: DataFrame, rows: int = ROWS) -> Classifier:
    """The classifier of docs (doc_id, text, lang), which must be training rows only."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tagged = docs.where("lang is not null and text is not null").select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    counts = spark.read.parquet(write_stage(tagged.groupBy("lang").agg(F.count("*").alias("n")), "langs"))
    each = max(1, rows // max(1, counts.count()))
    drawn = tagged.join(counts.withColumnRenamed("lang", "lang_"), F.col("lang") == F.col("lang_")).where(
        F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1_000_000)) < F.lit(each * 1_000_000.0) / F.col("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows_ = [np.packbits(r > 0).tobytes() for x in presence(part.column(0)) for r in x]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(rows_, pa.binary())], ["lang", "bits"])

    found = sorted((r["lang"], bytes(r["bits"])) for r in drawn.select("text", "lang").mapInArrow(run, "lang string, bits binary").collect())
    x = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for _, b in found], np.float32).reshape(len(found), 1 << BITS)
    return Classifier(x, [lang for lang, _ in found])


def identified(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs, scores = classifier.predict(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = plain.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identified(docs, fit(docs.where(~held_out())))


QUERIES = {"op8_language": op8_language}
ORACLE: dict[str, str] = {}
