"""Deduplication, clipping, regular grid, provenance flags, bounded fill, farm frame, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.timeline import over_slots, regular_slots, slot_of
from gustline.settings import CLIP_LIMITS, DEFAULTS, FARM_SERIES, SENSORS, FarmSettings


def first_reading(df: DataFrame, keys: Sequence[str], order: Sequence[str], unique: bool = False) -> DataFrame:
    """Keep the earliest row per key.

    `min_by` combines before the shuffle, so a key repeated in a large share of the rows costs one
    row per task rather than one huge window partition. When the single order column is known to be
    `unique` within a key, columns are picked one by one, which stays in a hash aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    if unique and len(order) == 1:
        return df.groupBy(*keys).agg(*[
            (F.min(c) if c == order[0] else F.min_by(c, order[0])).alias(c) for c in rest])
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    ).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def clip_readings(df: DataFrame) -> DataFrame:
    return df.withColumns({s: clip(F.col(s), *CLIP_LIMITS[s]) for s in SENSORS if s in df.columns})


def time_bounds(df: DataFrame, settings: FarmSettings = DEFAULTS, ts: str = "ts") -> tuple[Column, Column]:
    """First and last slot as scalar subqueries; give the leanest frame that has them."""
    slots = df.select(slot_of(F.col(ts), settings.interval_minutes).alias("slot"))
    return slots.agg(F.min("slot")).scalar(), slots.agg(F.max("slot")).scalar()


def to_regular_grid(
    df: DataFrame,
    settings: FarmSettings = DEFAULTS,
    bounds: tuple[Column, Column] | None = None,
    turbines: DataFrame | None = None,
) -> DataFrame:
    """Left-join readings onto every slot between the farm's first and last reading."""
    low, high = bounds or time_bounds(df, settings)
    turbines = turbines if turbines is not None else df.select("turbine_id").distinct()
    grid = regular_slots(turbines, low, high, settings.interval_minutes)
    marked = df.withColumn("_seen", F.lit(1))
    seen = F.coalesce(F.col("_seen"), F.lit(0))
    return grid.join(marked, ["turbine_id", "ts"], "left").select(
        *df.columns, seen.alias("is_observed"), (1 - seen).alias("is_synthetic")
    )


def missing_flags(df: DataFrame) -> DataFrame:
    """0/1 column per sensor, to be taken before any fill."""
    return df.withColumns({f"{s}_missing": F.col(s).isNull().cast("int") for s in SENSORS})


def any_power_missing(df: DataFrame) -> DataFrame:
    """Slot-level flag: at least one turbine has no power reading."""
    return df.groupBy("ts").agg(F.max(F.col("power").isNull().cast("int")).alias("any_power_missing"))


def fill_stage(settings: FarmSettings = DEFAULTS, sensors: Sequence[str] = SENSORS):
    """The fill as a stage for `over_slots`, so that later stages of the same pass see filled values.

    Such a pass must reach `max_fill_slots` further back than its own windows do.
    """
    def stage(window):
        reach = window.rowsBetween(-settings.max_fill_slots, 0)
        filled = {s: F.last(s, ignorenulls=True).over(reach) for s in sensors}
        flag = F.lit(False)
        for s in sensors:
            flag = flag | (F.col(s).isNull() & filled[s].isNotNull())
        return {**filled, "is_imputed": flag.cast("int")}

    return stage


def fill_forward(
    df: DataFrame, settings: FarmSettings = DEFAULTS, span: int | None = None
) -> DataFrame:
    """Carry the last value at most `max_fill_slots` slots and flag the rows that changed."""
    return over_slots(
        df, ["turbine_id"], settings.interval_minutes, settings.max_fill_slots, 0, fill_stage(settings), span=span)


def row_imputed(df: DataFrame) -> DataFrame:
    """Slot-level rule: a slot counts as imputed when any turbine was filled there."""
    return df.groupBy("ts").agg(F.max("is_imputed").alias("row_is_imputed"))


def operating_status(power: Column, wind: Column) -> Column:
    return (
        F.when(wind > 25, "curtailed")
        .when(power >= 50, "generating")
        .when((power > 0) & (power < 50), "partial_load")
        .when(power == 0, "stopped")
        .when(power.isNull() & wind.isNotNull(), "stopped")
        .when(wind.isNull(), "no_data")
        .otherwise("unknown")
    )


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", operating_status(F.col("power"), F.col("wind_speed")))


def evaluation_cutoff(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """One row: the earlier of the report date and the last timestamp."""
    report = F.lit(settings.report_date).cast("timestamp_ntz")
    return df.agg(F.least(report, F.max("ts")).alias("cutoff"))


def flag_simulated(df: DataFrame, cutoff: Column) -> DataFrame:
    return df.withColumn("is_simulated", (F.col("ts") >= cutoff).cast("int"))


def farm_frame(df: DataFrame, skipna_zero: bool = False) -> DataFrame:
    """Farm totals per slot; null when no turbine reports, or 0 with `skipna_zero`."""
    total = F.sum("power")
    return df.groupBy("ts").agg(
        (F.coalesce(total, F.lit(0.0)) if skipna_zero else total).alias("farm_total_power"),
        F.avg("power").alias("farm_avg_power"),
        F.count_if(F.col("power") > 0).alias("farm_active_turbines"),
        F.avg("wind_speed").alias("farm_avg_wind_speed"),
        F.stddev_samp("wind_speed").alias("farm_wind_std"),
    )


def series_frame(df: DataFrame, farm_flags: str = "any") -> DataFrame:
    """Turbines and the farm total as series of one long frame.

    `farm_flags` says whether a farm slot counts as imputed when any or when all turbines were.
    """
    pick = F.max if farm_flags == "any" else F.min
    own = df.select(
        F.col("turbine_id").alias("series_id"), "ts", "power", "wind_speed",
        "is_observed", "is_imputed", "is_simulated",
    )
    farm = df.groupBy("ts").agg(
        F.sum("power").alias("power"),
        F.avg("wind_speed").alias("wind_speed"),
        F.max("is_observed").alias("is_observed"),
        pick("is_imputed").alias("is_imputed"),
        F.max("is_simulated").alias("is_simulated"),
    ).select(F.lit(FARM_SERIES).alias("series_id"), "*")
    return own.unionByName(farm)


def clean(df: DataFrame, settings: FarmSettings = DEFAULTS, order: Sequence[str] = ("reading_no",),
          stamps: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """The fixed cleaning order: dedupe, clip, grid, flags, fill, status, cutoff.

    Bounds, turbines and cutoff are read from `stamps` (turbine_id, ts) where given, a leaner scan than
    the readings themselves.
    """
    grid, cutoff = cleaned_grid(df, settings, order, stamps, unique)
    return (
        grid.transform(fill_forward, settings)
        .transform(with_status)
        .transform(flag_simulated, cutoff)
    )


def cleaned_grid(df: DataFrame, settings: FarmSettings = DEFAULTS, order: Sequence[str] = ("reading_no",),
                 stamps: DataFrame | None = None, unique: bool = False) -> tuple[DataFrame, Column]:
    """The steps before the fill, and the cutoff: for passes that fill and add features together."""
    stamps = df if stamps is None else stamps
    bounds = time_bounds(stamps, settings)
    turbines = stamps.select("turbine_id").distinct()
    cutoff = evaluation_cutoff(stamps, settings).scalar()
    single = first_reading(df.select("turbine_id", "ts", *order, *SENSORS), ["turbine_id", "ts"], order, unique)
    grid = to_regular_grid(clip_readings(single.drop(*order)), settings, bounds, turbines)
    return missing_flags(grid), cutoff
