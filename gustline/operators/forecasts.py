"""Forecast tables, intervals, daily aggregates, quality labels and champions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.functions.quantiles import exact_quantiles
from gustline.settings import FARM_SERIES

GROUP = ["series_id", "horizon", "model"]
# Horizon name -> minutes, and the horizon from which a forecast is reference only.
HORIZON_MINUTES = {"10min": 10, "30min": 30, "1hour": 60, "6hour": 360, "24hour": 1440}
REFERENCE_FROM = 360
MIN_RESIDUALS = 10
NORMAL_WIDTH = 1.96


def forecast_table(predictions: DataFrame) -> DataFrame:
    """(ts, series_id, horizon, model, predicted, actual, error, rated)."""
    return predictions.select(
        "ts", "series_id", "horizon", "model", F.col("y_pred").alias("predicted"),
        F.col("y_true").alias("actual"), (F.col("y_true") - F.col("y_pred")).alias("error"), "rated",
    ).where(F.col("predicted").isNotNull())


def _clamp(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.col("rated"))


def _spread(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy(*GROUP).agg(
        F.count("error").alias("_n"), F.stddev_samp("predicted").alias("_std"),
        F.stddev_pop("predicted").alias("_std_pop"))


def quantile_intervals(forecasts: DataFrame, confidence: float = 0.9) -> DataFrame:
    """Bounds from the signed residual quantiles of each (series, horizon, model).

    Below ten residuals: 1.96 standard deviations of the forecast, or 5 % and 15 % of it without spread.
    """
    alpha = 1 - confidence
    q = exact_quantiles(forecasts, GROUP, "error", [alpha / 2, 1 - alpha / 2]).groupBy(*GROUP).agg(
        F.min_by("quantile", "prob").alias("_lo"), F.max_by("quantile", "prob").alias("_hi"))
    wide = attach(forecasts, _spread(forecasts).join(q, GROUP, "left"), GROUP)
    p, few = F.col("predicted"), F.col("_n") < MIN_RESIDUALS
    flat = F.coalesce(F.col("_std") == 0, F.lit(True))
    low = F.when(few & flat, p * 0.05).when(few, p - NORMAL_WIDTH * F.col("_std")).otherwise(p + F.col("_lo"))
    high = F.when(few & flat, p * 0.15).when(few, p + NORMAL_WIDTH * F.col("_std")).otherwise(p + F.col("_hi"))
    return wide.select(*forecasts.columns, _clamp(low).alias("lower_bound"), _clamp(high).alias("upper_bound"))


def symmetric_intervals(forecasts: DataFrame, confidence: float = 0.9) -> DataFrame:
    """Bounds at plus and minus the quantile of the absolute residual."""
    sized = forecasts.withColumn("_abs", F.abs("error"))
    q = exact_quantiles(sized, GROUP, "_abs", [confidence]).select(*GROUP, F.col("quantile").alias("_q"))
    wide = attach(forecasts, _spread(forecasts).join(q, GROUP, "left"), GROUP)
    p, few = F.col("predicted"), F.col("_n") < MIN_RESIDUALS
    flat = F.coalesce(F.col("_std_pop") == 0, F.lit(True))
    low = F.when(few & flat, p * 0.95).when(few, p - NORMAL_WIDTH * F.col("_std_pop")).otherwise(p - F.col("_q"))
    high = F.when(few & flat, p * 1.15).when(few, p + NORMAL_WIDTH * F.col("_std_pop")).otherwise(p + F.col("_q"))
    return wide.select(
        *forecasts.columns,
        F.greatest(low, F.lit(0.0)).alias("y_low"), F.least(high, F.col("rated")).alias("y_high"))


def residual_quantiles(official: DataFrame, q: float = 0.95) -> DataFrame:
    """Quantile of the absolute residual per (series, horizon, model) with at least ten rows."""
    sized = official.withColumn("_abs", F.abs(F.col("y_true") - F.col("y_pred")))
    out = exact_quantiles(sized, GROUP, "_abs", [q])
    return out.where(F.col("n") >= MIN_RESIDUALS).select(
        *GROUP, F.col("quantile").alias("q"), F.col("n").alias("n_samples"))


def horizon_minutes(horizon: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, minutes in HORIZON_MINUTES.items():
        out = F.when(horizon == name, F.lit(minutes)).otherwise(out)
    return out


def quality(minutes: Column) -> Column:
    return F.when(minutes >= REFERENCE_FROM, "reference_only").otherwise("production")


def daily_forecast(intervals: DataFrame) -> DataFrame:
    """Mean forecast and bounds per day, series, horizon and model, clipped to the series' rated power."""
    rows = intervals.withColumn("horizon_min", horizon_minutes(F.col("horizon")))
    day = F.to_date("ts").cast("timestamp_ntz")
    out = rows.groupBy(
        day.alias("day"), "series_id", "horizon_min", "model", quality(F.col("horizon_min")).alias("forecast_quality"),
    ).agg(
        F.avg("predicted").alias("y_pred"), F.max("rated").alias("rated"),
        F.avg("y_low").alias("y_low"), F.avg("y_high").alias("y_high"),
    )
    return out.withColumns({
        "y_low": F.greatest(F.col("y_low"), F.lit(0.0)), "y_high": F.least(F.col("y_high"), F.col("rated")),
    }).drop("rated")


def daily_power_forecast(intervals: DataFrame) -> DataFrame:
    return daily_forecast(intervals.where(F.col("series_id") != FARM_SERIES))


def daily_farm_forecast(intervals: DataFrame) -> DataFrame:
    """Farm forecast per day with energy = power x horizon / 60."""
    out = daily_forecast(intervals.where(F.col("series_id") == FARM_SERIES)).drop("series_id")
    return out.withColumnsRenamed(
        {"y_pred": "farm_power_pred", "y_low": "farm_power_low", "y_high": "farm_power_high"}
    ).withColumn("farm_energy_pred", F.col("farm_power_pred") * F.col("horizon_min") / 60)


def quality_counts(daily: DataFrame) -> DataFrame:
    return daily.groupBy("forecast_quality").agg(F.count("*").alias("n_rows"))


def level_of(series: Column) -> Column:
    return F.when(series.startswith("farm"), "farm").otherwise("turbine")


def champions(metrics: DataFrame, deployable: list[str] | None = None) -> DataFrame:
    """Model with the lowest mean RMSE per level and horizon; names break ties."""
    rows = metrics.where(F.col("model").isin(deployable)) if deployable else metrics
    means = rows.groupBy(level_of(F.col("series_id")).alias("level"), "horizon", "model").agg(F.avg("rmse").alias("rmse"))
    return means.groupBy("level", "horizon").agg(
        F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse"))


def registry(metrics: DataFrame, deployable: list[str], version: str = "v5",
             training_cutoff: Column | None = None) -> DataFrame:
    """Champions with the key of the stored model and its metadata."""
    best = champions(metrics, deployable)
    base = F.when(F.col("level") == "farm", FARM_SERIES).otherwise("turbine_power")
    return best.select(
        "level", "horizon", "model", "rmse",
        F.concat(base, F.lit("_target_"), F.col("horizon"), F.lit("_"), F.col("model")).alias("model_key"),
        F.lit(version).alias("feature_version"),
        (training_cutoff if training_cutoff is not None else F.lit(None).cast("timestamp_ntz")).alias("training_cutoff"),
        F.lit("PASS").alias("quality_flag"),
    )


def champions_beside_best(metrics: DataFrame, learned: list[str]) -> DataFrame:
    """Champion over all models with the best learned model beside it."""
    best = champions(metrics, learned).select(
        "level", "horizon", F.col("model").alias("best_learned"), F.col("rmse").alias("best_learned_rmse"))
    return champions(metrics).join(best, ["level", "horizon"], "left")


def champion_counts(best: DataFrame) -> DataFrame:
    return best.groupBy("level", "model").agg(F.count("*").alias("n_cells"))
