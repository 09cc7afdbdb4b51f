"""Error breakdowns and summaries over the metrics table and the scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.operators.features import season
from gustline.operators.forecasts import level_of


# Bin edges in m/s and the labels printed for them.
WIND_EDGES = (0, 3, 6, 9, 12, 15, 20, 30, 60)
WIND_LABELS = ("0-3", "3-6", "6-9", "9-12", "12-15", "15-20", "20-25", "25+")
MIN_BIN_ROWS = 5
# Power regions in kW.
POWER_REGIONS = ((0, 500, "Low (0-500kW)"), (500, 1500, "Medium (500-1500kW)"), (1500, 2200, "High (1500-2200kW)"))
SEASONS = {1: "Spring", 2: "Summer", 3: "Autumn", 4: "Winter"}
METRICS = ("mae", "rmse", "nmae_pct", "nrmse_pct", "bias", "r2")
BASELINES = ("persistence", "ridge")


def abs_error() -> Column:
    return F.abs(F.col("y_pred") - F.col("y_true"))


# ---- over the metrics table

def model_summary(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("model").agg(*[F.avg(m).alias(m) for m in METRICS])


def r2_by_horizon(metrics: DataFrame) -> DataFrame:
    """Mean and spread of R2 per horizon and model, with the horizon's best cell."""
    best = F.struct("r2", "series_id", "model")
    spread = metrics.groupBy("horizon", "model").agg(F.avg("r2").alias("r2_mean"), F.stddev_samp("r2").alias("r2_std"))
    tops = metrics.groupBy("horizon").agg(
        F.avg("r2").alias("horizon_r2_mean"), F.max_by("series_id", best).alias("best_series"),
        F.max_by("model", best).alias("best_model"))
    return spread.join(tops, "horizon")


def parity_gap(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """Largest difference of mean R2 between two models over horizons, turbines and farm apart."""
    means = metrics.groupBy(level_of(F.col("series_id")).alias("level"), "horizon").agg(
        F.avg(F.when(F.col("model") == first, F.col("r2"))).alias("a"),
        F.avg(F.when(F.col("model") == second, F.col("r2"))).alias("b"))
    return means.groupBy("level").agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("max_gap"))


def walk_forward_extremes(summary: DataFrame) -> DataFrame:
    """Per model: the largest RMSE spread, its horizon, and the number of folds."""
    order = F.struct("rmse_std", "horizon")
    return summary.groupBy("model").agg(
        F.max("rmse_std").alias("largest_std"), F.max_by("horizon", order).alias("at_horizon"),
        F.max("n_folds").alias("n_folds"))


def baseline_against_learned(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("horizon", "model").agg(F.avg("rmse").alias("mean_rmse")).withColumn(
        "kind", F.when(F.col("model").isin(*BASELINES), "baseline").otherwise("learned"))


def model_ranking(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("model").agg(
        F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2"), F.avg("mae").alias("mae")).orderBy("rmse", "model")


def metric_spread(metrics: DataFrame) -> DataFrame:
    names = [*METRICS, *[c for c in ("skill_vs_persistence",) if c in metrics.columns]]
    return metrics.where(level_of(F.col("series_id")) == "turbine").groupBy("horizon", "model").agg(*[
        fn(n).alias(f"{n}_{label}") for n in names
        for label, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])


def matrix(metrics: DataFrame, rows: str, columns: str, values: Sequence[str], metric: str = "r2") -> DataFrame:
    """Pivot of a metric's mean with listed column values."""
    return metrics.groupBy(rows).pivot(columns, list(values)).agg(F.avg(metric))


def ablation_side_by_side(results: DataFrame, sets: tuple[str, str]) -> DataFrame:
    """With and without a feature block, per series and horizon."""
    def of(name: str, metric: str) -> Column:
        return F.max(F.when(F.col("feature_set") == name, F.col(metric))).alias(f"{metric}_{name}")

    out = results.groupBy("series_id", "horizon").agg(*[of(s, m) for s in sets for m in ("rmse", "r2")])
    return out.withColumn("rmse_change", F.col(f"rmse_{sets[1]}") - F.col(f"rmse_{sets[0]}"))


# ---- best model per horizon and what it gets wrong

def best_per_horizon(metrics: DataFrame) -> DataFrame:
    """Series and model with the highest R2 per horizon, baselines left out."""
    order = F.struct("r2", "series_id", "model")
    learned = metrics.where(~F.col("model").isin(*BASELINES) & F.col("r2").isNotNull())
    return learned.groupBy("horizon").agg(
        F.max_by("series_id", order).alias("series_id"), F.max_by("model", order).alias("model"),
        F.max("r2").alias("r2"))


def best_rows(predictions: DataFrame, best: DataFrame) -> DataFrame:
    """Scored test rows of each horizon's best model."""
    scored = predictions.where(
        (F.col("split") == "test") & F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    return attach(scored, best.select("horizon", "series_id", "model"), ["horizon", "series_id", "model"])


def wind_bin(wind: Column) -> Column:
    """Label of the wind bin; the outer bins take everything beyond the edges."""
    out = F.lit(WIND_LABELS[-1])
    for edge, label in reversed(list(zip(WIND_EDGES[1:-1], WIND_LABELS[:-1], strict=True))):
        out = F.when(wind < edge, label).otherwise(out)
    return F.when(wind.isNotNull(), out)


def mae_by_wind(rows: DataFrame) -> DataFrame:
    binned = rows.where(F.col("wind_speed").isNotNull()).groupBy("horizon", wind_bin(F.col("wind_speed")).alias("wind_bin"))
    return binned.agg(F.avg(abs_error()).alias("mae"), F.count("*").alias("n")).where(F.col("n") > MIN_BIN_ROWS)


def power_region(power: Column) -> Column:
    out = F.lit(None).cast("string")
    for low, high, label in POWER_REGIONS:
        out = F.when((power >= low) & (power < high), label).otherwise(out)
    return out


def mae_by_power(rows: DataFrame) -> DataFrame:
    region = power_region(F.col("y_true"))
    return rows.where(region.isNotNull()).groupBy("horizon", region.alias("region")).agg(
        F.avg(abs_error()).alias("mae"), F.count("*").alias("n"))


def mae_by_season(rows: DataFrame) -> DataFrame:
    label = F.lit(None).cast("string")
    number = season(F.month("ts"))
    for n, name in SEASONS.items():
        label = F.when(number == n, name).otherwise(label)
    return rows.groupBy("horizon", label.alias("season")).agg(F.avg(abs_error()).alias("mae"), F.count("*").alias("n"))


def mae_by_day_night(rows: DataFrame) -> DataFrame:
    hour = F.hour("ts")
    part = F.when((hour >= 6) & (hour < 18), "Day (6-18h)").otherwise("Night (18-6h)")
    return rows.groupBy("horizon", part.alias("part")).agg(F.avg(abs_error()).alias("mae"), F.count("*").alias("n"))


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """Equal-width density histogram per group between its own least and largest value."""
    rows = df.where(F.col(value).isNotNull())
    spans = rows.groupBy(*keys).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(bins - 1)).cast("int")
    placed = attach(rows, spans, keys).withColumn("bin", F.coalesce(place, F.lit(0)))
    out = placed.groupBy(*keys, "bin").agg(
        F.count("*").alias("count"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_n").alias("_n"))
    return out.select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("left_edge"), "count",
        F.try_divide(F.col("count"), F.col("_n") * width).alias("density"))


def residual_histogram(rows: DataFrame, bins: int = 60) -> DataFrame:
    return histogram(rows.withColumn("residual", F.col("y_true") - F.col("y_pred")), ["horizon"], "residual", bins)


def power_distribution(df: DataFrame, turbines: Sequence[str] | None = None, bins: int = 80) -> DataFrame:
    """Power histogram of the listed turbines, or of all."""
    rows = df.where(F.col("turbine_id").isin(*turbines)) if turbines else df
    return histogram(rows, ["turbine_id"], "power", bins)
