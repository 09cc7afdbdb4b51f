"""Joining small per-key tables onto many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gustline.session import write_stage


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-key table (fits, means, quantiles) to the rows it describes.

    The table is stored first, so its size is known when the join is planned: below
    `spark.sql.autoBroadcastJoinThreshold` it is broadcast and the rows stay where they are; above it
    Spark sort-merges and splits skewed keys.
    """
    spark = rows.sparkSession
    stored = spark.read.schema(table.schema).parquet(write_stage(table, "attach"))
    return rows.join(stored, list(keys), how)
