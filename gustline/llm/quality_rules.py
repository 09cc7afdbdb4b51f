"""Quality rules with risk-controlled thresholds (operator 7).

Fixed base rules drop texts that are too short or repeat themselves. Beyond them each rule rejects a text whose feature lies above
a cutoff of its stratum (the language tag). A quarter of the labelled rows proposes cutoffs: the one that rejects most bad
texts, each good text it rejects counting `price` bad ones. The other three quarters test them: going down from the strictest
acceptable cutoff, a cutoff holds while the exact (Clopper-Pearson) upper bound of the share of good texts rejected is at
most `risk`. The level is split over all strata and rules (Bonferroni); within one rule the fixed order needs no further
correction. A rule without a certified cutoff rejects nothing, so strata with few labels keep all that passes the base.

Defined results: null, empty and blank texts have no words and fail the base; labels of unknown or null ids are ignored, and of
repeated labels each counts; a null language is a stratum of its own; extra columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import (
    GAP, bounded_batches, mix, per_row, repeated, slices, span_hashes, spans, utf8, window_starts, windows,
)
from gustline.session import write_stage

MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
LEVEL, RISK, PRICE, BINS = 0.05, 0.01, 20, 100
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares in percent of words (symbols, exclamation marks, repeats), of lines and of letters.
RULES = {
    "symbols": "100 * n_symbols / n_words", "exclaims": "100 * n_exclaims / n_words", "upper": "100 * n_upper / word_chars",
    "dup_lines": "100 * n_dup_lines / n_lines", "repeats": "100 * n_repeat_words / n_words",
}
FEATURES = [*BASE, "n_lines", "n_upper", "n_exclaims"]


def features(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Counts of one batch of texts, as defined by the names in FEATURES."""
    data, bounds = utf8(part.column(part.schema.get_field_index("text")))
    starts, ends, rows = spans(data, bounds)
    solid = ~GAP[data]
    out = {"n_words": np.diff(rows), "word_chars": per_row(solid & ((data & 0xC0) != 0x80), bounds),
           "n_symbols": per_row(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), bounds)}
    newline = np.zeros(256, bool)
    newline[10] = True
    line_starts, line_ends, line_rows = spans(data, bounds, newline)
    words_in = np.searchsorted(starts, line_ends) - np.searchsorted(starts, line_starts)
    line_row = np.repeat(np.arange(part.num_rows), np.diff(line_rows))
    used = words_in > 0
    hashes, line_row = span_hashes(data, line_starts[used], line_ends[used]), line_row[used]
    lines = np.bincount(line_row, minlength=part.num_rows)
    keys = np.unique(mix(hashes + mix(line_row.astype(np.uint64))), return_index=True)[1]
    out["n_dup_lines"] = lines - np.bincount(line_row[keys], minlength=part.num_rows)
    rolled, row = windows(span_hashes(data, starts, ends), rows, WINDOW)
    first, _ = window_starts(rows, WINDOW)
    first = first[repeated(mix(rolled + mix(row.astype(np.uint64))))]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, np.minimum(first + WINDOW, len(starts)), -1)
    out["n_repeat_words"] = per_row(np.cumsum(cover)[:-1] > 0, rows)
    out |= {"n_lines": lines, "n_upper": per_row((data >= 65) & (data <= 90), bounds), "n_exclaims": per_row(data == 33, bounds)}
    return out


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs and the columns FEATURES, which must not clash; docs has a string column text."""
    bounded_batches(docs.sparkSession)
    schema = docs.select(*keep).schema
    for name in FEATURES:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = features(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in keep]
                    + [pa.array(found[c].astype(np.int64)) for c in FEATURES], [*keep, *FEATURES])

    return docs.select(*keep, *[c for c in ["text"] if c not in keep]).mapInArrow(run, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed from the largest term down."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    terms = np.arange(0, k + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in terms]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def bound_holds(k: int, n: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound at this level of a rate with k of n is at most risk: P(X <= k | risk) <= level."""
    return n > 0 and k < n * risk and binomial_cdf(k, n, risk) <= level


def choose(counts: pd.DataFrame, level: float, risk: float = RISK, price: float = PRICE) -> int | None:
    """Certified bin of one stratum and rule, or None. counts: bin, good, hold, n; a cutoff b rejects bins >= b."""
    grid = np.zeros((2, 2, BINS + 1))
    np.add.at(grid, (counts["good"].astype(int), counts["hold"].astype(int), counts["bin"].astype(int)), counts["n"])
    above = grid[:, :, ::-1].cumsum(2)[:, :, ::-1]
    gain = above[0, 0] - price * above[1, 0]
    gain[0] = 0
    if gain.max() <= 0:
        return None
    best = np.flatnonzero(gain == gain.max())
    wanted, total = int(best[len(best) // 2]), above[1, 1, 0]
    passed = None
    for b in range(BINS, wanted - 1, -1):
        if not bound_holds(int(above[1, 1, b]), int(total), risk, level):
            break
        passed = b
    return passed


def measured(docs: DataFrame) -> DataFrame:
    """id, stratum and features of every row of docs, stored: the texts themselves are never shuffled."""
    plain = docs.select(F.col("doc_id").alias("id"), stratum().alias("stratum"), F.col("text").cast("string").alias("text"))
    return docs.sparkSession.read.parquet(write_stage(with_features(plain, ["id", "stratum"]), "features"))


def thresholds(rows: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, one cutoff per rule) from all labelled rows of measured(); a null cutoff rejects nothing."""
    spark = rows.sparkSession
    marks = labels.select(F.col("doc_id").alias("of"), (F.col("quality") == 1).alias("good")).where("good is not null")
    marked = rows.join(marks, F.col("id") == F.col("of")).where(f"not ({failed()})")
    bins = F.array(*[F.struct(F.lit(r).alias("rule"), F.least(F.floor(F.expr(e)), F.lit(BINS)).cast("int").alias("bin")) for r, e in RULES.items()])
    counted = (marked.select("stratum", "good", (F.crc32(F.col("id").cast("string")) % 4 != 0).alias("hold"), F.explode(bins).alias("f"))
               .groupBy("stratum", "good", "hold", "f.rule", "f.bin").agg(F.count("*").alias("n")))
    counted = spark.read.parquet(write_stage(counted, "risk"))
    tests = max(1, counted.select("stratum").distinct().count()) * len(RULES)

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        cut = {r: choose(frame[frame["rule"] == r], level / tests, risk) if (frame["rule"] == r).any() else None for r in RULES}
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], **{f"cut_{r}": pd.array([cut[r]], "Int32") for r in RULES}})

    schema = "stratum string, " + ", ".join(f"cut_{r} int" for r in RULES)
    return spark.read.parquet(write_stage(counted.groupBy("stratum").applyInPandas(pick, schema), "cutoffs"))


def stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))


def failed() -> str:
    return f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"


def judged(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """rows (stratum and features) with base_failed and kept."""
    rows = rows.join(cuts.withColumnRenamed("stratum", "of"), F.col("stratum") == F.col("of"), "left")
    broken = [F.coalesce(F.floor(F.expr(e)) >= F.col(f"cut_{r}"), F.lit(False)) for r, e in RULES.items()]
    any_broken = F.array_contains(F.array(*broken), True)
    return rows.withColumn("base_failed", F.expr(failed())).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(any_broken, F.lit(False)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that the rules keep, with all their columns."""
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}_") for i, c in enumerate(names)], stratum().alias("stratum"),
                        F.col("text").cast("string").alias("text"))
    rows = with_features(inner, [*[f"c{i}_" for i in range(len(names))], "stratum"])
    kept = judged(rows, thresholds(measured(docs), labels)).where("kept")
    return kept.select(*[F.col(f"c{i}_").alias(c) for i, c in enumerate(names)])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    cuts = thresholds(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(rows, cuts).select(F.col("id").alias("doc_id"), *BASE, "base_failed", "kept")


QUERIES = {"op7_quality_rules": op7_quality_rules}
ORACLE: dict[str, str] = {}
