"""Registered queries of forecasts, scoring and breakdowns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustline.operators import breakdowns as B
from gustline.operators import forecasts as H
from gustline.operators import models as G
from gustline.operators import scoring as I
from gustline.operators import splits as S
from gustline.plans.q_clean import clean_frame, farm_settings
from gustline.plans.q_features import bounds, series_targets
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.plans.stages import stage
from gustline.settings import HORIZONS
from gustline.sources.derived import DERIVED

LEARNED = ["linear_wind", "linear_roll"]
SCORES = ("mae", "rmse", "nmae_pct", "nrmse_pct", "bias", "r2", "max_error")


def rounded(df, digits=4, skip=()):
    return df.withColumns({n: F.round(n, digits) for n, t in df.dtypes if t == "double" and n not in skip})


def r4(names, prefix=""):
    return ", ".join(f"round({prefix}{n}, 4) AS {n}" for n in names)


def predictions(spark, sf):
    return stage(spark, sf, "predictions", lambda: G.base_predictions(
        series_targets(spark, sf), farm_settings(spark, sf)))


def test_predictions(spark, sf):
    """The test rows of `predictions`, worked out and stored without the others."""
    return stage(spark, sf, "test_predictions", lambda: G.base_predictions(
        series_targets(spark, sf), farm_settings(spark, sf)).where("split = 'test'"))


def official(spark, sf):
    return I.official_rows(test_predictions(spark, sf))


def metrics(spark, sf):
    return I.metrics(official(spark, sf))


# ---- models with closed forms

@query("g1_persistence", f"SELECT series_id, horizon, {r4(SCORES)}, n_samples FROM t_metrics WHERE model = 'persistence'")
def g1(spark, sf):
    return rounded(metrics(spark, sf).where("model = 'persistence'").drop("model"))


@query("g2_ridge", """
SELECT series_id, horizon, n, round(wp / ps, 6) AS power_coef, round(ww / ws, 6) AS wind_coef,
  round(ym - wp / ps * pm - ww / ws * wm, 4) AS intercept
FROM (SELECT *, (b1 * c22 - b2 * c12) / (c11 * c22 - c12 * c12) AS wp, (b2 * c11 - b1 * c12) / (c11 * c22 - c12 * c12) AS ww
  FROM (SELECT *, 1 + 1.0::DOUBLE / n AS c11, 1 + 1.0::DOUBLE / n AS c22, cpw / ps / ws AS c12, cpy / ps AS b1, cwy / ws AS b2
    FROM (SELECT series_id, horizon, count(*) AS n, avg(power) AS pm, avg(wind_speed) AS wm, avg(y_true) AS ym,
      stddev_pop(power) AS ps, stddev_pop(wind_speed) AS ws, covar_pop(power, wind_speed) AS cpw,
      covar_pop(power, y_true) AS cpy, covar_pop(wind_speed, y_true) AS cwy
      FROM t_target WHERE split = 'train' AND power IS NOT NULL AND wind_speed IS NOT NULL AND y_true IS NOT NULL
      GROUP BY ALL)))""")
def g2(spark, sf):
    train = series_targets(spark, sf).where("split = 'train'")
    fits = G.fit_linear(train, ["power", "wind_speed"], alpha=1.0)
    return fits.select(
        "series_id", "horizon", "n", F.round(F.col("coefs")[0], 6).alias("power_coef"),
        F.round(F.col("coefs")[1], 6).alias("wind_coef"), F.round("intercept", 4).alias("intercept"))


@query("g3_least_squares", """
SELECT series_id, horizon, round(wind_slope, 6) AS slope, round(wind_intercept, 4) AS intercept, n FROM t_fit""")
def g3(spark, sf):
    rows = series_targets(spark, sf).where("split = 'train' and power is not null and roll6 is not null")
    fits = G.fit_linear(rows, ["wind_speed"], alpha=0.0)
    return fits.select("series_id", "horizon", F.round(F.col("coefs")[0], 6).alias("slope"),
                       F.round("intercept", 4).alias("intercept"), "n")


cte("t_wf", """
SELECT t.series_id, t.horizon, fold, part, power, y_true FROM (
  SELECT s.*, fold, CASE WHEN pos < greatest(floor(n * (0.25::DOUBLE + (fold - 1) * 0.12::DOUBLE)), 100) THEN 'train'
    WHEN pos < floor(n * (0.25::DOUBLE + fold * 0.12::DOUBLE)) THEN 'validation' END AS part
  FROM t_target s CROSS JOIN (SELECT unnest(range(1, 6)) AS fold) CROSS JOIN t_bounds) t
WHERE part IS NOT NULL AND power IS NOT NULL AND y_true IS NOT NULL
""")
cte("t_wf_scores", """
SELECT v.series_id, v.horizon, v.fold, model, avg(abs(p - y_true)) AS mae, sqrt(avg((p - y_true) ** 2)) AS rmse,
  coalesce(1 - sum((p - y_true) ** 2) / nullif(var_pop(y_true) * count(*), 0), 0) AS r2, count(*) AS n_samples
FROM (SELECT w.*, model, CASE model WHEN 'persistence' THEN power
        ELSE ym + n * xy / xs / (n + 1.0::DOUBLE) / xs * (power - xm) END AS p
      FROM t_wf w JOIN (SELECT series_id, horizon, fold, count(*) AS n, avg(power) AS xm, stddev_pop(power) AS xs,
          avg(y_true) AS ym, covar_pop(power, y_true) AS xy FROM t_wf WHERE part = 'train' GROUP BY ALL) f
        ON f.series_id = w.series_id AND f.horizon = w.horizon AND f.fold = w.fold
      CROSS JOIN (VALUES ('persistence'), ('ridge')) m(model) WHERE part = 'validation') v
GROUP BY ALL
""")
cte("t_wf_summary", """
SELECT model, horizon, avg(rmse) AS rmse_mean, stddev_samp(rmse) AS rmse_std, avg(r2) AS r2_mean,
  stddev_samp(r2) AS r2_std, count(DISTINCT fold) AS n_folds, count(*) AS n_evaluations
FROM t_wf_scores GROUP BY ALL
""")


def wf_scores(spark, sf):
    return G.walk_forward_scores(S.walk_forward(series_targets(spark, sf), bounds(spark, sf), DERIVED))


@query("g9_walk_forward", """
SELECT model, horizon, round(rmse_mean, 4) AS rmse_mean, round(rmse_std, 4) AS rmse_std, round(r2_mean, 4) AS r2_mean,
  round(r2_std, 4) AS r2_std, n_folds, n_evaluations FROM t_wf_summary""")
def g9(spark, sf):
    return rounded(G.walk_forward_summary(wf_scores(spark, sf)))


@query("g13_baseline_predictions", """
SELECT series_id, ts, horizon, model, round(y_pred, 4) AS y_pred FROM t_pred
WHERE split = 'test' AND model IN ('persistence', 'ridge')""")
def g13(spark, sf):
    rows = test_predictions(spark, sf).where("split = 'test' and model in ('persistence', 'ridge')")
    return rows.select("series_id", "ts", "horizon", "model", F.round("y_pred", 4).alias("y_pred"))


# ---- forecast tables

cte("t_fc", """
SELECT ts, series_id, horizon, model, y_pred AS predicted, y_true AS actual, y_true - y_pred AS error, rated
FROM t_pred WHERE split = 'test' AND is_simulated = 0 AND y_pred IS NOT NULL
""")
cte("t_spread", """
SELECT series_id, horizon, model, count(error) AS n, stddev_samp(predicted) AS s1, stddev_pop(predicted) AS s0,
  quantile_cont(error, 0.05) AS lo, quantile_cont(error, 0.95) AS hi, quantile_cont(abs(error), 0.9) AS q
FROM t_fc GROUP BY ALL
""")


def forecasts(spark, sf):
    rows = test_predictions(spark, sf).where("split = 'test' and is_simulated = 0")
    return H.forecast_table(rows)


@query("h1_forecast_table", """
SELECT ts, series_id, horizon, model, round(predicted, 4) AS predicted, actual, round(error, 4) AS error FROM t_fc""")
def h1(spark, sf):
    return rounded(forecasts(spark, sf).drop("rated"), skip=("actual",))


@query("h2_quantile_intervals", """
SELECT f.ts, f.series_id, f.horizon, f.model, round(predicted, 4) AS predicted,
  round(least(greatest(CASE WHEN n < 10 AND coalesce(s1, 0) = 0 THEN predicted * 0.05 WHEN n < 10 THEN predicted - 1.96 * s1
    ELSE predicted + lo END, 0), rated), 4) AS lower_bound,
  round(least(greatest(CASE WHEN n < 10 AND coalesce(s1, 0) = 0 THEN predicted * 0.15 WHEN n < 10 THEN predicted + 1.96 * s1
    ELSE predicted + hi END, 0), rated), 4) AS upper_bound
FROM t_fc f JOIN t_spread s ON s.series_id = f.series_id AND s.horizon = f.horizon AND s.model = f.model""")
def h2(spark, sf):
    out = H.quantile_intervals(forecasts(spark, sf))
    return rounded(out.drop("actual", "error", "rated"))


cte("t_iv", """
SELECT f.*, greatest(CASE WHEN n < 10 AND coalesce(s0, 0) = 0 THEN predicted * 0.95 WHEN n < 10 THEN predicted - 1.96 * s0
    ELSE predicted - q END, 0) AS y_low,
  least(CASE WHEN n < 10 AND coalesce(s0, 0) = 0 THEN predicted * 1.15 WHEN n < 10 THEN predicted + 1.96 * s0
    ELSE predicted + q END, rated) AS y_high
FROM t_fc f JOIN t_spread s ON s.series_id = f.series_id AND s.horizon = f.horizon AND s.model = f.model
""")
cte("t_daily", """
SELECT date_trunc('day', ts)::TIMESTAMP AS day, series_id, CASE horizon WHEN '10min' THEN 10 WHEN '30min' THEN 30 WHEN '1hour' THEN 60
    WHEN '6hour' THEN 360 ELSE 1440 END AS horizon_min, model,
  CASE WHEN horizon IN ('6hour', '24hour') THEN 'reference_only' ELSE 'production' END AS forecast_quality,
  avg(predicted) AS y_pred, greatest(avg(y_low), 0) AS y_low, least(avg(y_high), max(rated)) AS y_high
FROM t_iv GROUP BY ALL
""")


@query("h3_symmetric_intervals", """
SELECT ts, series_id, horizon, model, round(predicted, 4) AS predicted, round(y_low, 4) AS y_low, round(y_high, 4) AS y_high
FROM t_iv""")
def h3(spark, sf):
    return rounded(H.symmetric_intervals(forecasts(spark, sf)).drop("actual", "error", "rated"))


@query("h4_residual_quantiles", """
SELECT series_id, horizon, model, round(quantile_cont(abs(y_true - y_pred), 0.95), 4) AS q, count(*) AS n_samples
FROM t_test GROUP BY ALL HAVING count(*) >= 10""")
def h4(spark, sf):
    return rounded(H.residual_quantiles(official(spark, sf)))


def daily_source(spark, sf):
    return H.symmetric_intervals(forecasts(spark, sf))


@query("h5_daily_power", """
SELECT day, series_id, horizon_min, model, forecast_quality, round(y_pred, 6) AS y_pred, round(y_low, 6) AS y_low,
  round(y_high, 6) AS y_high FROM t_daily WHERE series_id <> 'farm_total_power'""")
def h5(spark, sf):
    return rounded(H.daily_power_forecast(daily_source(spark, sf)), 6)


@query("h6_daily_farm", """
SELECT day, horizon_min, model, forecast_quality, round(y_pred, 6) AS farm_power_pred, round(y_low, 6) AS farm_power_low,
  round(y_high, 6) AS farm_power_high, round(y_pred * horizon_min / 60, 6) AS farm_energy_pred
FROM t_daily WHERE series_id = 'farm_total_power'""")
def h6(spark, sf):
    return rounded(H.daily_farm_forecast(daily_source(spark, sf)), 6)


@query("h7_quality_counts", """
SELECT forecast_quality, count(*) AS n_rows FROM t_daily WHERE series_id <> 'farm_total_power' GROUP BY ALL""")
def h7(spark, sf):
    return H.quality_counts(H.daily_power_forecast(daily_source(spark, sf)))


cte("t_means", """
SELECT CASE WHEN series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END AS level, horizon, model, avg(rmse) AS rmse
FROM t_metrics GROUP BY ALL
""")


@query("h8_champions", """
SELECT level, horizon, model, round(rmse, 4) AS rmse,
  CASE level WHEN 'farm' THEN 'farm_total_power' ELSE 'turbine_power' END || '_target_' || horizon || '_' || model AS model_key,
  'v5' AS feature_version, (SELECT max(ts) FROM t_split WHERE split = 'train') AS training_cutoff, 'PASS' AS quality_flag
FROM (SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn FROM t_means
  WHERE model IN ('linear_wind', 'linear_roll')) WHERE rn = 1""")
def h8(spark, sf):
    split = S.split_by_time(clean_frame(spark, sf), bounds(spark, sf), DERIVED)
    cutoff = split.where("split = 'train'").agg(F.max("ts")).scalar()
    return rounded(H.registry(metrics(spark, sf), LEARNED, training_cutoff=cutoff))


@query("h9_champions_beside_best", """
SELECT a.level, a.horizon, a.model, round(a.rmse, 4) AS rmse, b.model AS best_learned, round(b.rmse, 4) AS best_learned_rmse
FROM (SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn FROM t_means) a
JOIN (SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn FROM t_means
  WHERE model IN ('linear_wind', 'linear_roll')) b ON a.level = b.level AND a.horizon = b.horizon AND b.rn = 1
WHERE a.rn = 1""")
def h9(spark, sf):
    return rounded(H.champions_beside_best(metrics(spark, sf), LEARNED))


@query("g17_champion_scores", """
WITH champ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn
    FROM t_means) WHERE rn = 1),
q AS (SELECT series_id, horizon, model, quantile_cont(abs(y_true - y_pred), 0.95) AS q FROM t_test
  GROUP BY ALL HAVING count(*) >= 10)
SELECT p.series_id, p.ts, p.horizon, p.model,
  round(CASE WHEN y_pred IS NOT NULL THEN least(greatest(y_pred, 0), rated) END, 4) AS forecast,
  round(CASE WHEN y_pred IS NOT NULL AND q IS NOT NULL THEN least(greatest(least(greatest(y_pred, 0), rated) - q, 0), rated) END, 4) AS lower,
  round(CASE WHEN y_pred IS NOT NULL AND q IS NOT NULL THEN least(greatest(least(greatest(y_pred, 0), rated) + q, 0), rated) END, 4) AS upper,
  CASE WHEN y_pred IS NULL THEN 'MISSING_MODEL' ELSE 'PASS' END AS quality_flag
FROM t_pred p JOIN champ c ON c.horizon = p.horizon AND c.model = p.model
  AND c.level = CASE WHEN p.series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END
LEFT JOIN q ON q.series_id = p.series_id AND q.horizon = p.horizon AND q.model = p.model
WHERE p.split = 'test'""")
def g17(spark, sf):
    rows = test_predictions(spark, sf)
    requests = series_targets(spark, sf).where("split = 'test'").select("series_id", "ts", "horizon")
    scored = I.official_rows(rows)
    return rounded(G.champion_scores(
        requests, rows, H.champions(I.metrics(scored)), H.residual_quantiles(scored), farm_settings(spark, sf)))


# ---- scoring

@query("i1_metrics", f"SELECT series_id, horizon, model, {r4(SCORES)}, n_samples FROM t_metrics")
def i1(spark, sf):
    return rounded(metrics(spark, sf))


@query("i9_regression_gate", """
WITH now AS (SELECT series_id, horizon, rmse, r2 FROM t_metrics WHERE model = 'linear_wind' AND horizon <> '24hour'),
old AS (SELECT series_id, horizon, rmse AS stored_rmse, r2 AS stored_r2 FROM t_metrics WHERE model = 'linear_roll' AND horizon <> '10min')
SELECT series_id, horizon, round(rmse, 4) AS rmse, round(stored_rmse, 4) AS stored_rmse, round(r2, 4) AS r2, round(stored_r2, 4) AS stored_r2,
  CASE WHEN rmse IS NULL THEN 'GONE' WHEN stored_rmse IS NULL THEN 'NEW' WHEN rmse > stored_rmse * 1.15::DOUBLE OR r2 < stored_r2 * 0.9::DOUBLE THEN 'FAIL'
    ELSE 'PASS' END AS status FROM now FULL JOIN old USING (series_id, horizon)""")
def i9_gate(spark, sf):
    """Scores of one model against the stored ones of the model it would replace; each lacks a horizon of the other."""
    table = metrics(spark, sf)
    now = table.where("model = 'linear_wind' AND horizon <> '24hour'")
    return rounded(I.regression_gate(now, table.where("model = 'linear_roll' AND horizon <> '10min'")))


@query("i2_rated_power", "SELECT DISTINCT series_id, rated FROM t_pred")
def i2(spark, sf):
    return predictions(spark, sf).select("series_id", "rated").distinct()


cte("t_beside", """
SELECT t.*, p.y_pred AS yp, r.y_pred AS yr FROM t_test t
LEFT JOIN t_test p ON p.series_id = t.series_id AND p.ts = t.ts AND p.horizon = t.horizon AND p.model = 'persistence'
LEFT JOIN t_test r ON r.series_id = t.series_id AND r.ts = t.ts AND r.horizon = t.horizon AND r.model = 'ridge'
""")
cte("t_eval", """
SELECT series_id, horizon, model, avg(abs(y_pred - y_true)) AS mae, sqrt(avg((y_pred - y_true) ** 2)) AS rmse,
  avg(abs(y_pred - y_true)) / min(rated) * 100 AS nmae_pct, sqrt(avg((y_pred - y_true) ** 2)) / min(rated) * 100 AS nrmse_pct,
  avg(y_pred - y_true) AS bias, 1 - sum((y_pred - y_true) ** 2) / (var_pop(y_true) * count(*)) AS r2,
  max(abs(y_pred - y_true)) AS max_error, count(*) AS n_samples,
  sqrt(avg((y_pred - y_true) ** 2) FILTER (y_true < rated * 0.95 AND y_true > rated * 0.01)) AS rmse_excl_capacity_zero,
  count(*) FILTER (y_true >= rated * 0.95) AS n_at_capacity, count(*) FILTER (y_true <= rated * 0.01) AS n_zero_power,
  1 - sqrt(avg((y_pred - y_true) ** 2) FILTER (yp IS NOT NULL)) / nullif(sqrt(avg((yp - y_true) ** 2)), 0) AS skill_vs_persistence,
  1 - sqrt(avg((y_pred - y_true) ** 2) FILTER (yr IS NOT NULL)) / nullif(sqrt(avg((yr - y_true) ** 2)), 0) AS skill_vs_ridge
FROM t_beside GROUP BY ALL
""")


@query("i3_skill", """
SELECT series_id, horizon, model, round(skill_vs_persistence, 4) AS skill_vs_persistence,
  round(skill_vs_ridge, 4) AS skill_vs_ridge FROM t_eval""")
def i3(spark, sf):
    return rounded(I.skills(official(spark, sf)))


@query("i4_provenance_mask", """
SELECT turbine_id, ts, power FROM t_clean WHERE is_synthetic = 0 AND is_imputed = 0""")
def i4(spark, sf):
    return clean_frame(spark, sf).where(I.provenance_mask()).select("turbine_id", "ts", "power")


@query("i5_official_mask", """
SELECT turbine_id, ts, is_observed AS observed_target, is_imputed AS target_imputed,
  (SELECT coalesce(min(CASE WHEN is_simulated = 1 THEN ts END), max(ts) + INTERVAL '1 second') FROM t_clean) AS official_cutoff,
  is_observed = 1 AND is_imputed = 0
    AND ts < (SELECT coalesce(min(CASE WHEN is_simulated = 1 THEN ts END), max(ts) + INTERVAL '1 second') FROM t_clean) AS keep
FROM t_clean""")
def i5(spark, sf):
    df = I.official_columns(clean_frame(spark, sf)).withColumn("keep", I.official_mask())
    return df.select("turbine_id", "ts", "observed_target", "target_imputed", "official_cutoff", "keep")


@query("i5_mask_at_target", """
WITH moved AS (SELECT series_id, horizon, split, y_true, lead(is_observed, steps) OVER w AS o,
    lead(is_imputed, steps) OVER w AS i, lead(is_simulated, steps) OVER w AS s
  FROM t_target WINDOW w AS (PARTITION BY series_id, horizon ORDER BY ts))
SELECT series_id, horizon, count(*) AS n_kept, sum(y_true) AS power FROM moved
WHERE split = 'test' AND o = 1 AND i = 0 AND s = 0 AND y_true IS NOT NULL GROUP BY ALL""")
def i5_target(spark, sf):
    rows = I.flags_at_target(series_targets(spark, sf), DERIVED).withColumn("y_pred", F.lit(0.0))
    return I.official_rows(rows).groupBy("series_id", "horizon").agg(
        F.count("*").alias("n_kept"), F.sum("y_true").alias("power"))


@query("i6_mask_trace", """
SELECT turbine_id, ts, power, 1 AS official_mask_keep, true AS mask_observed_target, true AS mask_target_not_imputed,
  true AS mask_before_cutoff, true AS mask_prediction_available, true AS mask_feature_available
FROM t_clean WHERE is_observed = 1 AND is_imputed = 0
  AND ts < (SELECT coalesce(min(CASE WHEN is_simulated = 1 THEN ts END), max(ts) + INTERVAL '1 second') FROM t_clean)""")
def i6(spark, sf):
    out = I.mask_trace(I.official_columns(clean_frame(spark, sf)))
    return out.select("turbine_id", "ts", "power", *[c for c in out.columns if "mask" in c])


EVALUATED = (*SCORES, "rmse_excl_capacity_zero", "skill_vs_persistence", "skill_vs_ridge")


@query("i7_evaluate_all", f"""
SELECT series_id, horizon, model, {r4(EVALUATED)}, n_samples, n_at_capacity, n_zero_power FROM t_eval""")
def i7(spark, sf):
    return rounded(I.evaluate(official(spark, sf)))


@query("i8_baseline_rows", f"""
SELECT series_id, horizon, model, {r4(EVALUATED)}, n_samples, n_at_capacity, n_zero_power FROM t_eval
WHERE model IN ('persistence', 'ridge')""")
def i8(spark, sf):
    return rounded(I.evaluate(official(spark, sf).where("model in ('persistence', 'ridge')")))


@query("i9_metrics_table", """
SELECT series_id AS turbine_id, horizon, model AS model_version, round(mae, 4) AS mae_kw, round(rmse, 4) AS rmse_kw,
  round(nmae_pct, 4) AS nmae_pct, round(nrmse_pct, 4) AS nrmse_pct, round(bias, 4) AS bias_kw, round(r2, 4) AS r2,
  round(max_error, 4) AS max_error, round(skill_vs_persistence, 4) AS skill_score, n_samples FROM t_eval""")
def i9(spark, sf):
    return rounded(I.metrics_table(I.evaluate(official(spark, sf))))


cte("t_bias", """
SELECT f.horizon, f.model, f.slope, f.intercept, f.offs, f.n, f.b, f.m, avg(abs(f.slope * p.y_pred + f.intercept - p.y_true)) AS mc
FROM (SELECT horizon, model, regr_slope(y_true, y_pred) AS slope, regr_intercept(y_true, y_pred) AS intercept,
    avg(y_true - y_pred) AS offs, count(*) AS n, avg(y_pred - y_true) AS b, avg(abs(y_pred - y_true)) AS m
  FROM t_pred WHERE series_id = 'farm_total_power' AND split = 'validation' AND y_true IS NOT NULL AND y_pred IS NOT NULL
  GROUP BY ALL) f JOIN t_pred p ON p.horizon = f.horizon AND p.model = f.model AND p.series_id = 'farm_total_power'
    AND p.split = 'validation' AND p.y_true IS NOT NULL AND p.y_pred IS NOT NULL
GROUP BY ALL
""")


@query("i10_farm_metrics", """
SELECT t.horizon, t.model, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e ** 2)), 4) AS rmse,
  round(avg(abs(e)) / min(rated) * 100, 4) AS nmae_pct, round(sqrt(avg(e ** 2)) / min(rated) * 100, 4) AS nrmse_pct,
  round(avg(e), 4) AS bias, round(1 - sum(e ** 2) / (var_pop(y_true) * count(*)), 4) AS r2, round(max(abs(e)), 4) AS max_error,
  count(*) AS n_samples, count(*) FILTER (y_true >= rated * 0.95) AS n_at_capacity,
  count(*) FILTER (y_true <= rated * 0.01) AS n_zero_power,
  round(avg(abs(c)), 4) AS mae_corrected, round(sqrt(avg(c ** 2)), 4) AS rmse_corrected,
  round(avg(abs(c)) / min(rated) * 100, 4) AS nmae_pct_corrected, round(sqrt(avg(c ** 2)) / min(rated) * 100, 4) AS nrmse_pct_corrected,
  round(avg(c), 4) AS bias_corrected, round(1 - sum(c ** 2) / (var_pop(y_true) * count(*)), 4) AS r2_corrected,
  round(max(abs(c)), 4) AS max_error_corrected, count(*) AS n_samples_corrected,
  round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(offs, 4) AS scalar_offset_kw
FROM (SELECT t.*, slope, intercept, offs, y_pred - y_true AS e, slope * y_pred + intercept - y_true AS c
  FROM t_test t LEFT JOIN t_bias b ON b.horizon = t.horizon AND b.model = t.model WHERE series_id = 'farm_total_power') t
GROUP BY t.horizon, t.model, slope, intercept, offs""")
def i10(spark, sf):
    rows = predictions(spark, sf)
    return rounded(I.farm_metrics(I.official_rows(rows), I.fit_bias(rows)))


@query("i11_fit_bias", """
SELECT horizon, model, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(offs, 4) AS scalar_offset_kw,
  n AS n_samples, round(b, 4) AS val_bias_raw, round(m, 4) AS val_mae_raw, round(mc, 4) AS val_mae_corrected FROM t_bias""")
def i11(spark, sf):
    out = I.fit_bias(predictions(spark, sf))
    return rounded(out, skip=("slope",)).withColumn("slope", F.round("slope", 6))


@query("i12_apply_bias", """
SELECT series_id, ts, p.horizon, p.model, round(CASE WHEN series_id = 'farm_total_power' THEN slope * y_pred + intercept
  ELSE y_pred END, 4) AS y_corrected
FROM t_pred p LEFT JOIN t_bias b ON b.horizon = p.horizon AND b.model = p.model WHERE split = 'test'""")
def i12(spark, sf):
    rows = predictions(spark, sf)
    out = I.apply_bias(rows.where("split = 'test'"), I.fit_bias(rows))
    return out.select("series_id", "ts", "horizon", "model", F.round("y_corrected", 4).alias("y_corrected"))


@query("i13_horizon_windows", """
WITH f AS (SELECT ts, horizon, y_true AS y, y_pred AS p, rated FROM t_pred WHERE series_id = 'farm_total_power'
  AND model = 'ridge' AND split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
n AS (SELECT horizon, count(*) AS n FROM f GROUP BY ALL)
SELECT a.horizon AS horizon_a, b.horizon AS horizon_b, min(na.n) AS n_samples_a, min(nb.n) AS n_samples_b,
  count(*) AS n_common_samples, min(a.ts) AS window_start, max(a.ts) AS window_end,
  round(1 - sum((a.p - a.y) ** 2) / (var_pop(a.y) * count(*)), 4) AS r2_a,
  round(1 - sum((b.p - b.y) ** 2) / (var_pop(b.y) * count(*)), 4) AS r2_b,
  round((1 - sum((b.p - b.y) ** 2) / (var_pop(b.y) * count(*))) - (1 - sum((a.p - a.y) ** 2) / (var_pop(a.y) * count(*))), 4) AS r2_b_minus_a,
  count(*) FILTER (a.y >= a.rated * 0.95) AS n_at_capacity_a, count(*) FILTER (a.y <= a.rated * 0.01) AS n_zero_power_a,
  count(*) FILTER (b.y >= b.rated * 0.95) AS n_at_capacity_b, count(*) FILTER (b.y <= b.rated * 0.01) AS n_zero_power_b,
  count(*) = min(nb.n) AS window_identical
FROM f a JOIN f b ON a.ts = b.ts AND a.horizon <> b.horizon JOIN n na ON na.horizon = a.horizon
JOIN n nb ON nb.horizon = b.horizon GROUP BY a.horizon, b.horizon HAVING count(*) >= 2""")
def i13(spark, sf):
    return rounded(I.horizon_windows(predictions(spark, sf), "ridge", list(HORIZONS)))


@query("i14_farm_bias", """
WITH s AS (SELECT ts, horizon, max(y_pred) FILTER (series_id = 'farm_total_power') AS p,
    max(y_true) FILTER (series_id = 'farm_total_power') AS y, max(rated) AS rated,
    CASE WHEN count(*) FILTER (series_id <> 'farm_total_power' AND y_pred IS NOT NULL) = count(*) FILTER (series_id <> 'farm_total_power')
      THEN sum(y_pred) FILTER (series_id <> 'farm_total_power') END AS total
  FROM t_pred WHERE model = 'ridge' AND split = 'test' GROUP BY ALL)
SELECT horizon, count(*) AS n_samples, round(avg(y), 4) AS actual_mean_kw, round(avg(p), 4) AS farm_model_mean_kw,
  round(avg(p - y), 4) AS bias_kw, round(avg(p - y) / max(rated) * 100, 4) AS bias_pct_rated, round(avg(abs(p - y)), 4) AS mae_kw,
  round(avg(p - total), 4) AS farm_vs_sum_turbines_kw, count(*) FILTER (y >= rated * 0.95) AS n_at_capacity,
  count(*) FILTER (y <= rated * 0.01) AS n_zero_power
FROM s WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY ALL""")
def i14(spark, sf):
    return rounded(I.farm_bias(predictions(spark, sf), "ridge"))


cte("t_cov", """
SELECT t.series_id, t.horizon, t.model, l AS nominal_confidence, avg(CAST(abs(y_pred - y_true) <= q AS INTEGER)) AS empirical_coverage,
  2 * max(q) AS mean_interval_width, count(*) AS n_samples, abs(avg(CAST(abs(y_pred - y_true) <= q AS INTEGER)) - l) AS calibration_error
FROM t_test t JOIN (
  SELECT series_id, horizon, model, unnest([0.5::DOUBLE, 0.8::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS l,
    unnest(qs) AS q FROM (SELECT series_id, horizon, model, quantile_cont(abs(y_pred - y_true), [0.5, 0.8, 0.9, 0.95, 0.99]) AS qs
    FROM t_test GROUP BY series_id, horizon, model)) q
  ON q.series_id = t.series_id AND q.horizon = t.horizon AND q.model = t.model
GROUP BY t.series_id, t.horizon, t.model, l
""")


@query("i15_coverage", """
SELECT series_id, horizon, model, nominal_confidence, round(empirical_coverage, 4) AS empirical_coverage,
  round(mean_interval_width, 4) AS mean_interval_width, n_samples, round(calibration_error, 4) AS calibration_error FROM t_cov""")
def i15(spark, sf):
    return rounded(I.coverage(official(spark, sf)), skip=("nominal_confidence",))


@query("i15_coverage_breakdown", """
SELECT scope, target, nominal_confidence, round(avg(c), 4) AS empirical_coverage, round(avg(w), 4) AS mean_interval_width,
  CAST(sum(n) AS BIGINT) AS n_samples, round(abs(avg(c) - nominal_confidence), 4) AS calibration_error
FROM (SELECT nominal_confidence, c, w, n, unnest(['per_turbine', 'one_vs_others']) AS scope,
    unnest([series_id, CASE WHEN series_id = 'TB00002' THEN 'TB00002' ELSE 'all but TB00002' END]) AS target
  FROM (SELECT series_id, horizon, nominal_confidence, avg(empirical_coverage) AS c, avg(mean_interval_width) AS w, sum(n_samples) AS n
    FROM t_cov WHERE series_id <> 'farm_total_power' GROUP BY ALL)) GROUP BY scope, target, nominal_confidence""")
def i15_breakdown(spark, sf):
    out = I.coverage_breakdown(I.coverage(official(spark, sf)), "TB00002")
    return rounded(out, skip=("nominal_confidence",))


cte("t_conformal", """
SELECT l AS nominal, avg(CAST(e <= q AS INTEGER)) AS coverage, 2 * max(q) AS mean_width,
  abs(avg(CAST(e <= q AS INTEGER)) - l) AS calibration_error
FROM (SELECT *, (row_number() OVER (ORDER BY series_id, horizon, model, ts) - 1) % 2 AS half FROM (
    SELECT series_id, horizon, model, ts, abs(y_pred - y_true) AS e, count(*) OVER (PARTITION BY series_id, horizon, model) AS n
    FROM t_test) WHERE n >= 10) v
CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.8::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS l,
    unnest(quantile_cont(e, [0.5, 0.8, 0.9, 0.95, 0.99])) AS q FROM (
  SELECT *, (row_number() OVER (ORDER BY series_id, horizon, model, ts) - 1) % 2 AS half FROM (
    SELECT series_id, horizon, model, ts, abs(y_pred - y_true) AS e, count(*) OVER (PARTITION BY series_id, horizon, model) AS n
    FROM t_test) WHERE n >= 10) WHERE half = 0)
WHERE half = 1 GROUP BY l
""")


@query("i16_split_conformal", """
SELECT nominal, round(coverage, 6) AS coverage, round(mean_width, 4) AS mean_width, round(calibration_error, 6) AS calibration_error
FROM t_conformal""")
def i16(spark, sf):
    out = I.split_conformal(official(spark, sf), DERIVED)
    return out.withColumns({"coverage": F.round("coverage", 6), "mean_width": F.round("mean_width", 4),
                            "calibration_error": F.round("calibration_error", 6)})


@query("i32_coverage_extremes", """
SELECT arg_min(nominal, abs(nominal - 0.95)) AS nominal_95, round(arg_min(coverage, abs(nominal - 0.95)), 6) AS coverage_95,
  round(max(calibration_error), 6) AS worst_error, arg_max(nominal, calibration_error) AS worst_level FROM t_conformal""")
def i32(spark, sf):
    out = I.coverage_extremes(I.split_conformal(official(spark, sf), DERIVED))
    return out.withColumns({"coverage_95": F.round("coverage_95", 6), "worst_error": F.round("worst_error", 6)})


# ---- summaries of the metrics table

@query("i17_model_summary", """
SELECT model, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse, round(avg(nmae_pct), 4) AS nmae_pct,
  round(avg(nrmse_pct), 4) AS nrmse_pct, round(avg(bias), 4) AS bias, round(avg(r2), 4) AS r2 FROM t_metrics GROUP BY model""")
def i17(spark, sf):
    return rounded(B.model_summary(metrics(spark, sf)))


@query("i18_r2_by_horizon", """
SELECT a.horizon, a.model, round(avg(r2), 4) AS r2_mean, round(stddev_samp(r2), 4) AS r2_std, round(min(m), 4) AS horizon_r2_mean,
  min(bs) AS best_series, min(bm) AS best_model
FROM t_metrics a JOIN (SELECT horizon, avg(r2) AS m, arg_max(series_id, r2) AS bs, arg_max(model, r2) AS bm FROM t_metrics GROUP BY ALL) b
  ON a.horizon = b.horizon GROUP BY a.horizon, a.model""")
def i18(spark, sf):
    return rounded(B.r2_by_horizon(metrics(spark, sf)))


@query("i19_parity_gap", """
SELECT level, round(max(abs(a - b)), 4) AS max_gap FROM (
  SELECT CASE WHEN series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END AS level, horizon,
    avg(r2) FILTER (model = 'linear_wind') AS a, avg(r2) FILTER (model = 'linear_roll') AS b FROM t_metrics GROUP BY ALL)
GROUP BY level""")
def i19(spark, sf):
    return rounded(B.parity_gap(metrics(spark, sf), *LEARNED))


@query("i20_walk_forward_extremes", """
SELECT model, round(max(rmse_std), 4) AS largest_std, arg_max(horizon, rmse_std) AS at_horizon, max(n_folds) AS n_folds
FROM t_wf_summary GROUP BY model""")
def i20(spark, sf):
    return rounded(B.walk_forward_extremes(G.walk_forward_summary(wf_scores(spark, sf))))


cte("t_best", """
SELECT horizon, arg_max(series_id, r2) AS series_id, arg_max(model, r2) AS model, max(r2) AS r2 FROM t_metrics
WHERE model NOT IN ('persistence', 'ridge') GROUP BY horizon
""")
cte("t_best_rows", """
SELECT p.* FROM t_pred p JOIN t_best b ON b.horizon = p.horizon AND b.series_id = p.series_id AND b.model = p.model
WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL
""")


def best_rows(spark, sf):
    rows = test_predictions(spark, sf)
    return B.best_rows(rows, B.best_per_horizon(I.metrics(I.official_rows(rows))))


@query("i21_mae_by_wind", """
SELECT horizon, CASE WHEN wind_speed < 3 THEN '0-3' WHEN wind_speed < 6 THEN '3-6' WHEN wind_speed < 9 THEN '6-9'
  WHEN wind_speed < 12 THEN '9-12' WHEN wind_speed < 15 THEN '12-15' WHEN wind_speed < 20 THEN '15-20'
  WHEN wind_speed < 30 THEN '20-25' ELSE '25+' END AS wind_bin, round(avg(abs(y_pred - y_true)), 4) AS mae, count(*) AS n
FROM t_best_rows WHERE wind_speed IS NOT NULL GROUP BY ALL HAVING count(*) > 5""")
def i21(spark, sf):
    return rounded(B.mae_by_wind(best_rows(spark, sf)))


@query("i22_mae_by_power", """
SELECT horizon, CASE WHEN y_true < 500 THEN 'Low (0-500kW)' WHEN y_true < 1500 THEN 'Medium (500-1500kW)'
  ELSE 'High (1500-2200kW)' END AS region, round(avg(abs(y_pred - y_true)), 4) AS mae, count(*) AS n
FROM t_best_rows WHERE y_true >= 0 AND y_true < 2200 GROUP BY ALL""")
def i22(spark, sf):
    return rounded(B.mae_by_power(best_rows(spark, sf)))


@query("i23_mae_by_season", """
SELECT horizon, CASE WHEN month(ts) IN (3,4,5) THEN 'Spring' WHEN month(ts) IN (6,7,8) THEN 'Summer'
  WHEN month(ts) IN (9,10,11) THEN 'Autumn' ELSE 'Winter' END AS season, round(avg(abs(y_pred - y_true)), 4) AS mae, count(*) AS n
FROM t_best_rows GROUP BY ALL""")
def i23(spark, sf):
    return rounded(B.mae_by_season(best_rows(spark, sf)))


@query("i24_mae_day_night", """
SELECT horizon, CASE WHEN hour(ts) >= 6 AND hour(ts) < 18 THEN 'Day (6-18h)' ELSE 'Night (18-6h)' END AS part,
  round(avg(abs(y_pred - y_true)), 4) AS mae, count(*) AS n FROM t_best_rows GROUP BY ALL""")
def i24(spark, sf):
    return rounded(B.mae_by_day_night(best_rows(spark, sf)))


def histogram_sql(source, key, value, bins):
    return f"""
WITH s AS (SELECT {key}, {value} AS v FROM {source} WHERE {value} IS NOT NULL),
g AS (SELECT {key}, min(v) AS lo, max(v) AS hi, count(*) AS n, (max(v) - min(v)) / {bins} AS width FROM s GROUP BY ALL)
SELECT {key}, bin, round(lo + bin * width, 4) AS left_edge, count(*) AS count, round(count(*) / nullif(n * width, 0), 8) AS density
FROM (SELECT s.{key}, lo, n, width, CAST(coalesce(least(floor((v - lo) / nullif(width, 0)), {bins - 1}), 0) AS INTEGER) AS bin
  FROM s JOIN g ON g.{key} = s.{key}) GROUP BY {key}, bin, lo, n, width"""


def _histogram(df):
    return df.withColumns({"left_edge": F.round("left_edge", 4), "density": F.round("density", 8)})


@query("i25_residual_histogram", histogram_sql("t_best_rows", "horizon", "(y_true - y_pred)", 60))
def i25(spark, sf):
    return _histogram(B.residual_histogram(best_rows(spark, sf)))


@query("i25_error_histogram", histogram_sql("t_best_rows", "horizon", "(y_true - y_pred)", 80))
def i25_error(spark, sf):
    return _histogram(B.residual_histogram(best_rows(spark, sf), 80))


@query("i26_best_per_horizon", "SELECT horizon, series_id, model, round(r2, 4) AS r2 FROM t_best")
def i26(spark, sf):
    return rounded(B.best_per_horizon(metrics(spark, sf)))


def _pivot_sql(rows, column, values):
    cells = ", ".join(f"round(avg(r2) FILTER ({column} = '{v}'), 4) AS \"{v}\"" for v in values)
    return f"SELECT {rows}, {cells} FROM t_metrics GROUP BY {rows}"


@query("i27_turbine_horizon_matrix", _pivot_sql("series_id", "horizon", HORIZONS))
def i27(spark, sf):
    return rounded(B.matrix(metrics(spark, sf), "series_id", "horizon", list(HORIZONS)))


@query("i27_model_horizon_matrix", _pivot_sql("model", "horizon", HORIZONS))
def i27_model(spark, sf):
    return rounded(B.matrix(metrics(spark, sf), "model", "horizon", list(HORIZONS)))


@query("i27_turbine_model_matrix", _pivot_sql("series_id", "model", G.BASE_MODELS))
def i27_turbine(spark, sf):
    return rounded(B.matrix(metrics(spark, sf), "series_id", "model", list(G.BASE_MODELS)))


@query("i28_baseline_vs_learned", """
SELECT horizon, model, round(avg(rmse), 4) AS mean_rmse, CASE WHEN model IN ('persistence', 'ridge') THEN 'baseline'
  ELSE 'learned' END AS kind FROM t_metrics GROUP BY horizon, model""")
def i28(spark, sf):
    return rounded(B.baseline_against_learned(metrics(spark, sf)))


@query("i29_model_ranking", """
SELECT model, round(avg(rmse), 4) AS rmse, round(avg(r2), 4) AS r2, round(avg(mae), 4) AS mae FROM t_metrics GROUP BY model""")
def i29(spark, sf):
    return rounded(B.model_ranking(metrics(spark, sf)))


@query("i30_power_distribution", histogram_sql("t_clean", "turbine_id", "power", 80))
def i30(spark, sf):
    return _histogram(B.power_distribution(clean_frame(spark, sf)))


_SPREAD = ("mae", "rmse", "nmae_pct", "nrmse_pct", "bias", "r2", "skill_vs_persistence")


@query("i31_metric_spread", "SELECT horizon, model, " + ", ".join(
    f"round({fn}({n}), 4) AS {n}_{label}" for n in _SPREAD
    for label, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
) + " FROM t_eval WHERE series_id <> 'farm_total_power' GROUP BY horizon, model")
def i31(spark, sf):
    return rounded(B.metric_spread(I.evaluate(official(spark, sf))))


@query("i34_champion_counts", """
SELECT level, model, count(*) AS n_cells FROM (
  SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn FROM t_means) WHERE rn = 1 GROUP BY ALL""")
def i34(spark, sf):
    return H.champion_counts(H.champions(metrics(spark, sf)))


@query("b3_long_to_wide", """
SELECT series_id, ts, """ + ", ".join(f"max(y_true) FILTER (horizon = '{h}') AS \"{h}\"" for h in HORIZONS) + """
FROM t_target WHERE split = 'test' GROUP BY series_id, ts""")
def b3(spark, sf):
    rows = series_targets(spark, sf).where("split = 'test'")
    return rows.groupBy("series_id", "ts").pivot("horizon", list(HORIZONS)).agg(F.max("y_true"))
