"""Exact quantiles (linear interpolation) without gathering or sorting a group.

Values are first counted by logarithmic buckets, the counts combined before the shuffle. Only the buckets that hold a wanted rank are
counted again by buckets a thousand times finer, and only the values in the wanted ones of these are put in order. A
group with most of the rows thus costs two counting passes, and what is sorted does not follow its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.functions.joins import attach

COARSE, FINE = 64, 65536  # buckets per doubling


def _bucket(v: Column, per_doubling: int) -> Column:
    """Number of the bucket of a value, rising with the value; zero is a bucket of its own."""
    size = F.floor((F.least(F.log2(F.abs(v)), F.lit(1100.0)) + 1100) * per_doubling).cast("long")
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("long"))


def _ranks(probs: Sequence[float]) -> list[Column]:
    """The two ranks that each probability lies between, from the number of values `_n`."""
    last = F.col("_n") - 1
    lows = [F.floor(last * F.lit(float(p))) for p in probs]
    return [r for low in lows for r in (low, F.least(low + 1, last))]


def _wanted(counts: DataFrame, keys: Sequence[str], parent: Sequence[str], bucket: str, probs: Sequence[float]) -> DataFrame:
    """(keys, bucket, _before, _n) of the buckets that hold a wanted rank."""
    along = Window.partitionBy(*[F.col(k) for k in (*keys, *parent)] or [F.lit(0)]).orderBy(bucket)
    begin = F.col("_before") + F.sum("_c").over(along) - F.col("_c")
    placed = counts.select(*keys, bucket, "_n", "_c", begin.alias("_before"))
    hit = F.lit(False)
    for rank in _ranks(probs):
        hit = hit | ((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")))
    return placed.where(hit).select(*keys, bucket, "_before", "_n")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(keys, prob, quantile, n) for every probability; null values are ignored. The two counts run when this is called."""
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, v.alias("_v")).withColumns({
        "_coarse": _bucket(F.col("_v"), COARSE), "_fine": _bucket(F.col("_v"), FINE)})
    counts = rows.groupBy(*keys, "_coarse").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])
    counts = counts.withColumns({"_n": F.sum("_c").over(whole), "_before": F.lit(0).cast("long")})
    coarse = _wanted(counts, keys, [], "_coarse", probs)
    within = attach(rows, coarse, [*keys, "_coarse"]).groupBy(*keys, "_coarse", "_fine", "_before", "_n").agg(F.count("*").alias("_c"))
    fine = _wanted(within, keys, ["_coarse"], "_fine", probs)
    values = attach(rows, fine, [*keys, "_fine"]).groupBy(*keys, "_fine", "_before", "_n", "_v").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy(*keys, "_fine").orderBy("_v")
    end = F.col("_before") + F.sum("_c").over(inside)
    placed = values.select(*keys, "_v", "_n", (end - F.col("_c")).alias("_start"), end.alias("_end"))
    cells = [
        F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v"))).alias(f"_r{i}")
        for i, rank in enumerate(_ranks(probs))]
    wide = placed.groupBy(*keys).agg(F.max("_n").alias("n"), *cells)
    options = []
    for i, p in enumerate(probs):
        position = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        options.append(F.struct(F.lit(float(p)).alias("prob"), (low + (high - low) * (position - F.floor(position))).alias("quantile")))
    return wide.select(*keys, "n", F.explode(F.array(*options)).alias("_q")).select(*keys, "_q.prob", "_q.quantile", "n")
