"""Turbine readings derived from the `events` table.

Thirty users make one turbine, ten minutes make one slot, and a slot may carry two readings, so the
number of turbines and rows follows the size of the table. Values are multiples of a power of two:
sums are then exact in any order of addition.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.functions.timeline import slot_of, slot_start
from gustline.settings import FarmSettings

# The twelve places of a farm.
PLACES = [f"TB{i:02d}" for i in range(1, 13)]

# Report date that falls inside the span of the given tables.
DERIVED = FarmSettings(report_date="2024-01-29")


def settings_for(spark: SparkSession, sf_dir: str) -> FarmSettings:
    """Settings whose turbine count is that of the table."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = events.select(F.expr("user_id div 30")).distinct().count()
    return replace(DERIVED, n_turbines=n)


def turbine_name() -> Column:
    return F.format_string("TB%05d", F.expr("user_id div 30 + 1"))  # five digits at least, more where needed


def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turbine and slot time of every event, ungrouped: enough for bounds and the turbine list."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(turbine_name().alias("turbine_id"), slot_start(slot_of(F.col("ts"), 10), 10).alias("ts"))


def with_farm(df: DataFrame) -> DataFrame:
    """Twelve turbines make one farm: add its number and the turbine's place in it (`TB01` to `TB12`)."""
    number = F.substring("turbine_id", 3, 20).cast("long") - 1
    place = F.concat(F.lit("TB"), F.lpad((number % 12 + 1).cast("string"), 2, "0"))
    return df.withColumns({"farm_no": F.floor(number / F.lit(12)), "place": place})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(turbine_id, ts, reading_no, wind_speed, temperature, power, frequency), with duplicates."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cents = F.round(F.col("value") * 100).cast("long")

    def of(*kinds: str):
        return F.when(F.col("event_type").isin(*kinds), cents)

    def mean_of(step: int, *kinds: str):
        return F.floor(F.sum(of(*kinds)) / (F.count(of(*kinds)) * step)).cast("double")

    return events.groupBy(
        turbine_name().alias("turbine_id"),
        slot_start(slot_of(F.col("ts"), 10), 10).alias("ts"),
        (F.col("event_id") % 2).alias("reading_no"),
    ).agg(
        (mean_of(16, "view", "click", "signup") / 32).alias("wind_speed"),
        (mean_of(16, "error", "click", "signup") / 16 - 15).alias("temperature"),
        (F.sum(of("purchase", "signup", "click")).cast("double") / 4 - 40).alias("power"),
        (mean_of(64, "view", "click", "signup", "error", "purchase") / 16 + 46).alias("frequency"),
    )
