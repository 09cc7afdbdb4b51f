"""Registered queries of the cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustline.operators import cleaning as C
from gustline.plans.registry import query
from gustline.plans.stages import stage, value
from gustline.settings import SENSORS
from gustline.sources.derived import DERIVED, readings, settings_for, stamps


def clean_frame(spark, sf):
    return stage(spark, sf, "clean", lambda: C.clean(readings(spark, sf), DERIVED, stamps=stamps(spark, sf), unique=True))


def farm_settings(spark, sf):
    return value(spark, sf, "settings", lambda: settings_for(spark, sf))


def unique_frame(spark, sf):
    return C.first_reading(readings(spark, sf), ["turbine_id", "ts"], ["reading_no"], unique=True)


def grid_frame(spark, sf):
    raw = stamps(spark, sf)
    return C.to_regular_grid(
        C.clip_readings(unique_frame(spark, sf)).drop("reading_no"),
        DERIVED, C.time_bounds(raw, DERIVED), raw.select("turbine_id").distinct(),
    )


@query("d1_first_reading", "SELECT * FROM t_first")
def d1(spark, sf):
    return unique_frame(spark, sf)


@query("d2_clip_readings", "SELECT * FROM t_clip")
def d2(spark, sf):
    return C.clip_readings(unique_frame(spark, sf)).drop("reading_no")


@query("d3_regular_grid", "SELECT * FROM t_grid")
def d3(spark, sf):
    return grid_frame(spark, sf)


@query("d4_missing_flags", """
SELECT turbine_id, t.ts, CAST(wind_speed IS NULL AS INTEGER) AS wind_speed_missing,
  CAST(temperature IS NULL AS INTEGER) AS temperature_missing, CAST(power IS NULL AS INTEGER) AS power_missing,
  CAST(frequency IS NULL AS INTEGER) AS frequency_missing, any_power_missing
FROM t_grid t JOIN (SELECT ts, max(CAST(power IS NULL AS INTEGER)) AS any_power_missing FROM t_grid GROUP BY ts) a
  ON a.ts = t.ts""")
def d4(spark, sf):
    grid = grid_frame(spark, sf)
    return (
        C.missing_flags(grid).join(C.any_power_missing(grid), "ts")
        .select("turbine_id", "ts", *[f"{s}_missing" for s in SENSORS], "any_power_missing")
    )


@query("d5_fill_forward", """
SELECT turbine_id, f.ts, is_observed, is_synthetic, wind_speed, temperature, power, frequency, is_imputed,
  row_is_imputed
FROM t_filled f JOIN (SELECT ts, max(is_imputed) AS row_is_imputed FROM t_filled GROUP BY ts) r ON r.ts = f.ts""")
def d5(spark, sf):
    filled = C.fill_forward(grid_frame(spark, sf), DERIVED)
    return filled.join(C.row_imputed(filled), "ts")


@query("d6_farm_power", """
SELECT ts, sum(power) AS farm_total_power, coalesce(sum(power), 0.0) AS farm_total_power_zero_filled,
  avg(power) AS farm_avg_power, count(*) FILTER (power > 0) AS farm_active_turbines
FROM t_clean GROUP BY ts""")
def d6(spark, sf):
    farm = C.farm_frame(clean_frame(spark, sf))
    return farm.select(
        "ts", "farm_total_power",
        F.coalesce("farm_total_power", F.lit(0.0)).alias("farm_total_power_zero_filled"),
        "farm_avg_power", "farm_active_turbines",
    )


@query("d7_farm_wind", """
SELECT ts, avg(wind_speed) AS farm_avg_wind_speed, round(stddev_samp(wind_speed), 6) AS farm_wind_std
FROM t_clean GROUP BY ts""")
def d7(spark, sf):
    farm = C.farm_frame(clean_frame(spark, sf))
    return farm.select("ts", "farm_avg_wind_speed", F.round("farm_wind_std", 6).alias("farm_wind_std"))


@query("d8_operating_status", "SELECT turbine_id, ts, power, wind_speed, status FROM t_clean")
def d8(spark, sf):
    return clean_frame(spark, sf).select("turbine_id", "ts", "power", "wind_speed", "status")


@query("d9_evaluation_cutoff", """
SELECT turbine_id, is_simulated, min(cutoff) AS cutoff, count(*) AS n_rows FROM t_clean,
  (SELECT least(TIMESTAMP '2024-01-29', max(ts)) AS cutoff FROM t_raw) GROUP BY ALL""")
def d9(spark, sf):
    cutoff = C.evaluation_cutoff(stamps(spark, sf), DERIVED).scalar()
    return (
        clean_frame(spark, sf).groupBy("turbine_id", "is_simulated")
        .agg(F.count("*").alias("n_rows")).withColumn("cutoff", cutoff)
    )


@query("d10_clean_chain", "SELECT * FROM t_clean")
def d10(spark, sf):
    return C.clean(readings(spark, sf), DERIVED, stamps=stamps(spark, sf), unique=True)
