"""Official sample mask, metrics, skill, farm checks, bias correction, interval coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.functions.quantiles import exact_quantiles
from gustline.settings import FARM_SERIES

# How far RMSE may rise and R2 fall against the stored scores.
RMSE_FACTOR, R2_FACTOR = 1.15, 0.90

GROUP = ["series_id", "horizon", "model"]
LEVELS = (0.5, 0.8, 0.9, 0.95, 0.99)
MASK_COLUMNS = ("observed_target", "target_imputed", "official_cutoff", "prediction_available", "feature_available")
AT_CAPACITY, NEAR_ZERO = 0.95, 0.01


def truth_column() -> Column:
    return F.col("y_true")


def guess_column() -> Column:
    return F.col("y_pred")


def error_column() -> Column:
    return guess_column() - truth_column()


# ---- masks

def provenance_mask() -> Column:
    return (F.coalesce("is_synthetic", F.lit(0)) == 0) & (F.coalesce("is_imputed", F.lit(0)) == 0)


def official_columns(df: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Add whichever of the five mask columns are absent, from the provenance flags.

    Without a cutoff: the first simulated timestamp, else one second after the last timestamp.
    """
    if cutoff is None and "official_cutoff" not in df.columns:
        first = F.min(F.when(F.col("is_simulated") == 1, F.col("ts"))) if "is_simulated" in df.columns \
            else F.lit(None).cast("timestamp_ntz")
        cutoff = df.agg(F.coalesce(first, F.max("ts") + F.make_dt_interval(secs=F.lit(1)))).scalar()
    own = set(df.columns)
    values = {
        "observed_target": F.col("is_observed") if "is_observed" in own else F.lit(1),
        "target_imputed": F.coalesce("is_imputed", F.lit(0)) if "is_imputed" in own else F.lit(0),
        "official_cutoff": cutoff,
        "prediction_available": F.lit(1),
        "feature_available": F.lit(1),
    }
    return df.withColumns({k: v for k, v in values.items() if k not in own})


def official_mask() -> Column:
    def on(name: str) -> Column:
        return F.coalesce(F.col(name).cast("int"), F.lit(0)) == 1

    return (
        on("observed_target") & ~on("target_imputed") & (F.col("ts") < F.col("official_cutoff"))
        & on("prediction_available") & on("feature_available")
    )


def mask_trace(df: DataFrame) -> DataFrame:
    """Kept rows with one column per reason."""
    def on(name: str) -> Column:
        return F.coalesce(F.col(name).cast("int"), F.lit(0)) == 1

    return df.where(official_mask()).withColumns({
        "official_mask_keep": F.lit(1),
        "mask_observed_target": on("observed_target"),
        "mask_target_not_imputed": ~on("target_imputed"),
        "mask_before_cutoff": F.col("ts") < F.col("official_cutoff"),
        "mask_prediction_available": on("prediction_available"),
        "mask_feature_available": on("feature_available"),
    })


def official_rows(predictions: DataFrame) -> DataFrame:
    """Test rows that count, judged by the issue row's flags."""
    return predictions.where(
        (F.col("split") == "test") & (F.col("is_observed") == 1) & (F.col("is_imputed") == 0)
        & (F.col("is_simulated") == 0) & truth_column().isNotNull() & guess_column().isNotNull())


def flags_at_target(rows: DataFrame, settings) -> DataFrame:
    """Replace the issue row's flags by those of the target slot, for judging masks at t + h."""
    flags = ["is_observed", "is_imputed", "is_simulated"]
    later = rows.select("series_id", F.col("ts").alias("_target_ts"), *[F.col(f).alias(f"_{f}") for f in flags])
    later = later.groupBy("series_id", "_target_ts").agg(*[F.max(f"_{f}").alias(f"_{f}") for f in flags])
    moved = rows.withColumn(
        "_target_ts",
        F.col("ts") + F.make_dt_interval(mins=(F.col("steps") * settings.interval_minutes).cast("int")))
    joined = moved.join(later, ["series_id", "_target_ts"], "left")
    return joined.select(*[c for c in rows.columns if c not in flags], *[F.col(f"_{f}").alias(f) for f in flags])


# ---- metrics

def r_squared(error: Column, truth: Column) -> Column:
    return 1 - F.try_divide(F.sum(error * error), F.var_pop(truth) * F.count("*"))


def metric_columns(error: Column | None = None) -> list[Column]:
    error, truth = error_column() if error is None else error, truth_column()
    mae, rmse, rated = F.avg(F.abs(error)), F.sqrt(F.avg(error * error)), F.max("rated")
    return [
        mae.alias("mae"), rmse.alias("rmse"), (mae / rated * 100).alias("nmae_pct"),
        (rmse / rated * 100).alias("nrmse_pct"), F.avg(error).alias("bias"),
        r_squared(error, truth).alias("r2"), F.max(F.abs(error)).alias("max_error"), F.count("*").alias("n_samples"),
    ]


def metrics(official: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    return official.groupBy(*keys).agg(*metric_columns())


def segment_columns() -> list[Column]:
    at_capacity, near_zero = truth_column() >= F.col("rated") * AT_CAPACITY, truth_column() <= F.col("rated") * NEAR_ZERO
    inner = F.when(~(at_capacity | near_zero), error_column() * error_column())
    return [
        F.sqrt(F.avg(inner)).alias("rmse_excl_capacity_zero"),
        F.count_if(at_capacity).alias("n_at_capacity"), F.count_if(near_zero).alias("n_zero_power"),
    ]


def with_baselines(predictions: DataFrame, baselines: Sequence[str] = ("persistence", "ridge")) -> DataFrame:
    """Put each baseline's forecast of the same row beside every model's (one small group per row)."""
    row = Window.partitionBy("series_id", "ts", "horizon")
    return predictions.withColumns({
        f"y_{b}": F.max(F.when(F.col("model") == b, guess_column())).over(row) for b in baselines
    })


def skill_column(baseline: str) -> Column:
    """1 - RMSE(model) / RMSE(baseline) over rows where both exist."""
    other = F.col(f"y_{baseline}") - truth_column()
    both = other.isNotNull()
    own = F.sqrt(F.avg(F.when(both, error_column() * error_column())))
    return (1 - F.try_divide(own, F.sqrt(F.avg(other * other)))).alias(f"skill_vs_{baseline}")


def evaluate(official: DataFrame) -> DataFrame:
    """Metrics, skill against both baselines and segment counts per (series, horizon, model)."""
    return with_baselines(official).groupBy(*GROUP).agg(
        *metric_columns(), *segment_columns(), skill_column("persistence"), skill_column("ridge"))


def skills(official: DataFrame) -> DataFrame:
    return with_baselines(official).groupBy(*GROUP).agg(skill_column("persistence"), skill_column("ridge"))


def metrics_table(evaluated: DataFrame) -> DataFrame:
    """Published shape: turbine or farm, horizon, model and renamed columns."""
    return evaluated.select(
        F.col("series_id").alias("turbine_id"), "horizon", F.col("model").alias("model_version"),
        F.col("mae").alias("mae_kw"), F.col("rmse").alias("rmse_kw"), "nmae_pct", "nrmse_pct",
        F.col("bias").alias("bias_kw"), "r2", F.col("max_error").alias("max_error"),
        F.col("skill_vs_persistence").alias("skill_score"), "n_samples",
    )


# ---- farm level

def fit_bias(predictions: DataFrame) -> DataFrame:
    """Linear correction of the farm forecast per (horizon, model), fitted on validation rows."""
    keys = ["horizon", "model"]
    rows = predictions.where(
        (F.col("series_id") == FARM_SERIES) & (F.col("split") == "validation")
        & truth_column().isNotNull() & guess_column().isNotNull())
    fits = rows.groupBy(*keys).agg(
        F.regr_slope(truth_column(), guess_column()).alias("slope"), F.regr_intercept(truth_column(), guess_column()).alias("intercept"),
        F.avg(-error_column()).alias("scalar_offset_kw"), F.count("*").alias("n_samples"),
        F.avg(error_column()).alias("val_bias_raw"), F.avg(F.abs(error_column())).alias("val_mae_raw"),
    ).where(F.col("n_samples") >= 2)
    corrected = F.col("slope") * guess_column() + F.col("intercept")
    after = attach(rows, fits.select(*keys, "slope", "intercept"), keys).groupBy(*keys).agg(
        F.avg(F.abs(corrected - truth_column())).alias("val_mae_corrected"))
    return fits.join(after, keys)


def apply_bias(predictions: DataFrame, fits: DataFrame) -> DataFrame:
    """Add `y_corrected`; other series pass through unchanged."""
    keys = ["horizon", "model"]
    joined = attach(predictions, fits.select(*keys, "slope", "intercept"), keys, "left")
    fixed = F.when(
        (F.col("series_id") == FARM_SERIES) & F.col("slope").isNotNull(),
        F.col("slope") * guess_column() + F.col("intercept")).otherwise(guess_column())
    return joined.select(*predictions.columns, fixed.alias("y_corrected"))


def farm_metrics(official: DataFrame, fits: DataFrame) -> DataFrame:
    """Farm metrics with raw and corrected forecasts side by side, in one pass."""
    rows = apply_bias(official.where(F.col("series_id") == FARM_SERIES), fits)
    error = F.col("y_corrected") - truth_column()
    corrected = [
        c.alias(name) for c, name in zip(
            metric_columns(error),
            [f"{n}_corrected" for n in (
                "mae", "rmse", "nmae_pct", "nrmse_pct", "bias", "r2", "max_error", "n_samples")], strict=True)
    ]
    table = rows.groupBy("horizon", "model").agg(*metric_columns(), *segment_columns()[1:], *corrected)
    return table.join(fits.select("horizon", "model", "slope", "intercept", "scalar_offset_kw"),
                      ["horizon", "model"], "left")


def horizon_windows(predictions: DataFrame, model: str, horizons: Sequence[str]) -> DataFrame:
    """R2 of every ordered pair of farm horizons on the slots where both are scored.

    One row per slot holds all horizons; the pairs are those of the configured horizon list.
    """
    rows = predictions.where(
        (F.col("series_id") == FARM_SERIES) & (F.col("model") == model) & (F.col("split") == "test"))
    ok = truth_column().isNotNull() & guess_column().isNotNull()
    cell = F.struct(truth_column().alias("y"), guess_column().alias("p"))
    wide = rows.groupBy("ts", "rated").agg(*[
        F.max(F.when((F.col("horizon") == h) & ok, cell)).alias(h) for h in horizons])
    pairs = F.array(*[
        F.struct(F.lit(a).alias("horizon_a"), F.lit(b).alias("horizon_b"),
                 F.col(a).alias("a"), F.col(b).alias("b"))
        for a in horizons for b in horizons if a != b])
    long = wide.select("ts", "rated", F.explode(pairs).alias("_p")).select("ts", "rated", "_p.*")
    common = F.col("a").isNotNull() & F.col("b").isNotNull()

    def when(c: Column) -> Column:
        return F.when(common, c)

    def r2(side: str) -> Column:
        e = when(F.col(f"{side}.p") - F.col(f"{side}.y"))
        return 1 - F.try_divide(F.sum(e * e), F.var_pop(when(F.col(f"{side}.y"))) * F.count(e))

    counts = {}
    for side in ("a", "b"):
        y = when(F.col(f"{side}.y"))
        counts[f"n_at_capacity_{side}"] = F.count_if(y >= F.col("rated") * AT_CAPACITY)
        counts[f"n_zero_power_{side}"] = F.count_if(y <= F.col("rated") * NEAR_ZERO)
    out = long.groupBy("horizon_a", "horizon_b").agg(
        F.count("a").alias("n_samples_a"), F.count("b").alias("n_samples_b"),
        F.count_if(common).alias("n_common_samples"),
        F.min(when(F.col("ts"))).alias("window_start"), F.max(when(F.col("ts"))).alias("window_end"),
        r2("a").alias("r2_a"), r2("b").alias("r2_b"), *[c.alias(n) for n, c in counts.items()],
    ).where(F.col("n_common_samples") >= 2)
    return out.withColumns({
        "window_identical": F.col("n_common_samples") == F.col("n_samples_b"),
        "r2_b_minus_a": F.col("r2_b") - F.col("r2_a"),
    })


def farm_bias(predictions: DataFrame, model: str) -> DataFrame:
    """Direct farm forecast against the sum of the turbines' forecasts, joined on the slot."""
    rows = predictions.where((F.col("model") == model) & (F.col("split") == "test"))
    turbine = F.col("series_id") != FARM_SERIES
    farm = F.col("series_id") == FARM_SERIES
    slots = rows.groupBy("ts", "horizon").agg(
        F.max(F.when(farm, guess_column())).alias("p"), F.max(F.when(farm, truth_column())).alias("y"),
        F.max(F.when(farm, F.col("rated"))).alias("rated"),
        F.sum(F.when(turbine, guess_column())).alias("_sum"),
        F.count_if(turbine & guess_column().isNotNull()).alias("_have"), F.count_if(turbine).alias("_want"),
    ).where(F.col("p").isNotNull() & F.col("y").isNotNull())
    total = F.when(F.col("_have") == F.col("_want"), F.col("_sum"))
    e = F.col("p") - F.col("y")
    return slots.groupBy("horizon").agg(
        F.count("*").alias("n_samples"), F.avg("y").alias("actual_mean_kw"), F.avg("p").alias("farm_model_mean_kw"),
        F.avg(e).alias("bias_kw"), (F.avg(e) / F.max("rated") * 100).alias("bias_pct_rated"),
        F.avg(F.abs(e)).alias("mae_kw"), F.avg(F.col("p") - total).alias("farm_vs_sum_turbines_kw"),
        F.count_if(F.col("y") >= F.col("rated") * AT_CAPACITY).alias("n_at_capacity"),
        F.count_if(F.col("y") <= F.col("rated") * NEAR_ZERO).alias("n_zero_power"),
    )


# ---- regression gate

def regression_gate(current: DataFrame, stored: DataFrame, keys: Sequence[str] = ("series_id", "horizon"),
                    rmse_factor: float = RMSE_FACTOR, r2_factor: float = R2_FACTOR) -> DataFrame:
    """(keys, rmse, stored_rmse, r2, stored_r2, status) of every target scored now: FAIL where RMSE rose or R2 fell beyond the factor of what is stored,
    NEW for a target that is not stored. Stored targets that are no longer scored are GONE.
    """
    old = stored.select(*keys, F.col("rmse").alias("stored_rmse"), F.col("r2").alias("stored_r2"))
    both = current.select(*keys, "rmse", "r2").join(old, list(keys), "full")
    worse = (F.col("rmse") > F.col("stored_rmse") * rmse_factor) | (F.col("r2") < F.col("stored_r2") * r2_factor)
    return both.withColumn("status", F.when(F.col("rmse").isNull(), "GONE").when(F.col("stored_rmse").isNull(), "NEW").when(worse, "FAIL").otherwise("PASS"))


# ---- interval coverage

def coverage(official: DataFrame, levels: Sequence[float] = LEVELS) -> DataFrame:
    """Coverage and width of symmetric intervals, fitted and scored on the same rows."""
    sized = official.withColumn("_abs", F.abs(error_column()))
    q = exact_quantiles(sized, GROUP, "_abs", levels).groupBy(*GROUP).agg(
        F.sort_array(F.collect_list(F.struct("prob", "quantile"))).alias("_q"))
    rows = attach(sized, q, GROUP)
    cells = [F.count_if(F.col("_abs") <= F.col("_q")[i]["quantile"]).alias(f"_in{i}") for i in range(len(levels))]
    wide = rows.groupBy(*GROUP).agg(F.count("*").alias("n_samples"), F.max("_q").alias("_q"), *cells)
    options = F.array(*[
        F.struct(
            F.lit(float(level)).alias("nominal_confidence"),
            (F.col(f"_in{i}") / F.col("n_samples")).alias("empirical_coverage"),
            (F.col("_q")[i]["quantile"] * 2).alias("mean_interval_width"))
        for i, level in enumerate(sorted(levels))])
    out = wide.select(*GROUP, "n_samples", F.explode(options).alias("_o")).select(*GROUP, "n_samples", "_o.*")
    return out.withColumn("calibration_error", F.abs(F.col("empirical_coverage") - F.col("nominal_confidence")))


def coverage_breakdown(table: DataFrame, turbine_id: str) -> DataFrame:
    """Averages per turbine, and one turbine against all the rest."""
    per_target = table.where(F.col("series_id") != FARM_SERIES).groupBy(
        "series_id", "horizon", "nominal_confidence"
    ).agg(F.avg("empirical_coverage").alias("_c"), F.avg("mean_interval_width").alias("_w"),
          F.sum("n_samples").alias("_n"))
    group = F.when(F.col("series_id") == turbine_id, turbine_id).otherwise(f"all but {turbine_id}")
    views = F.array(
        F.struct(F.lit("per_turbine").alias("scope"), F.col("series_id").alias("target")),
        F.struct(F.lit("one_vs_others").alias("scope"), group.alias("target")))
    out = per_target.select("*", F.explode(views).alias("_v")).groupBy(
        "_v.scope", "_v.target", "nominal_confidence"
    ).agg(F.avg("_c").alias("empirical_coverage"), F.avg("_w").alias("mean_interval_width"),
          F.sum("_n").alias("n_samples"))
    return out.withColumn("calibration_error", F.abs(F.col("empirical_coverage") - F.col("nominal_confidence")))


def split_conformal(official: DataFrame, settings, levels: Sequence[float] = LEVELS) -> DataFrame:
    """Pooled residuals: even rows calibrate the quantile, odd rows score it.

    Rows run through targets in name order and by time within each. A row's parity is that of its place
    in its (target, day) plus the rows of all earlier days and targets, so only day counts are ordered as
    a whole.
    """
    keys = ["series_id", "horizon", "model"]
    rows = official.withColumn("_abs", F.abs(error_column())).withColumn("_day", F.to_date("ts"))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_size")).where(F.col("_size") >= 10)
    days = rows.groupBy(*keys, "_day").agg(F.count("*").alias("_c"))
    within = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_c").over(within), F.lit(0)))
    targets = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(targets), F.lit(0)))
    starts = days.join(offsets, keys).select(*keys, "_day", (F.col("_before") + F.col("_offset")).alias("_start"))
    inside = Window.partitionBy(*keys, "_day").orderBy("ts")
    placed = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, [*keys, "_day"])
    halves = placed.select("_abs", ((F.col("_start") + F.col("_rank")) % 2).alias("_half"))
    q = exact_quantiles(halves.where("_half = 0"), [], "_abs", levels).agg(
        F.sort_array(F.collect_list(F.struct("prob", "quantile")))).scalar()
    scored = halves.where("_half = 1").withColumn("_q", q)
    wide = scored.agg(
        F.count("*").alias("_n"), F.max("_q").alias("_q"),
        *[F.count_if(F.col("_abs") <= F.col("_q")[i]["quantile"]).alias(f"_in{i}") for i in range(len(levels))])
    options = F.array(*[
        F.struct(F.lit(float(level)).alias("nominal"), (F.col(f"_in{i}") / F.col("_n")).alias("coverage"),
                 (F.col("_q")[i]["quantile"] * 2).alias("mean_width"))
        for i, level in enumerate(sorted(levels))])
    out = wide.select(F.explode(options).alias("_o")).select("_o.*")
    return out.withColumn("calibration_error", F.abs(F.col("coverage") - F.col("nominal")))


def coverage_extremes(summary: DataFrame) -> DataFrame:
    """The level nearest 0.95 and the worst calibration error, from the summary table."""
    nearest = F.struct(F.abs(F.col("nominal") - 0.95), F.col("nominal"))
    return summary.agg(
        F.min_by("nominal", nearest).alias("nominal_95"), F.min_by("coverage", nearest).alias("coverage_95"),
        F.max("calibration_error").alias("worst_error"),
        F.max_by("nominal", F.struct("calibration_error", "nominal")).alias("worst_level"))
