"""Distributed running sums: positions in an order of all rows, or of the rows of each group, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.session import write_stage

ROWS_A_BUCKET = 1024


def buckets(rows: int) -> int:
    """Number of buckets that keep about ROWS_A_BUCKET rows each."""
    return max(1, -(-rows // ROWS_A_BUCKET))


def running(rows: DataFrame, group: list[str], bucket: str, order: list[Column], amount: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `amount` over the rows of the same group that come before, by bucket and then `order`.

    Only the sum of each bucket is summed across buckets; windows run inside one bucket of one group."""
    sums = rows.groupBy(*group, bucket).agg(F.sum(amount).alias("_sum"))
    sums = rows.sparkSession.read.parquet(write_stage(sums, "sums"))
    across = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(c).alias(f"_{c}") for c in (*group, bucket)], F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    same = [F.col(c) == F.col(f"_{c}") for c in (*group, bucket)]
    joined = rows.join(before, same).drop(*[f"_{c}" for c in (*group, bucket)])
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(out, F.col("_before") + F.coalesce(F.sum(amount).over(within), F.lit(0))).drop("_before")


def packed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs as one struct column `row_` beside the helper columns still to come, so that no name can clash; and its names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")), docs.columns
