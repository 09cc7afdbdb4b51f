"""Registered queries of the feature and split operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustline.functions.timeline import over_slots
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.operators import splits as S
from gustline.plans.q_clean import clean_frame, farm_settings
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.plans.stages import stage
from gustline.settings import HORIZONS, SENSORS
from gustline.sources.derived import DERIVED, PLACES, readings, stamps, with_farm

MAIN = ("power", "wind_speed", "temperature")


def bounds(spark, sf):
    return C.time_bounds(stamps(spark, sf), DERIVED)


def _over(names, spec):
    return ", ".join(
        f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c in names for k in spec)


@query("e1_lags", f"""
SELECT turbine_id, ts, {_over(MAIN, DERIVED.lags)}
FROM t_clean WINDOW w AS (PARTITION BY turbine_id ORDER BY ts)""")
def e1(spark, sf):
    df = clean_frame(spark, sf).select("turbine_id", "ts", *MAIN)
    return over_slots(df, ["turbine_id"], 10, max(DERIVED.lags), 0,
                      lambda w: E.lag_columns(w, MAIN, DERIVED.lags)).drop(*MAIN)


def _rolling_sql():
    cols = []
    for c in MAIN:
        for w in DERIVED.windows:
            over = f"OVER (PARTITION BY turbine_id ORDER BY ts ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
            cols += [f"avg({c}) {over} AS {c}_roll{w}_mean", f"min({c}) {over} AS {c}_roll{w}_min",
                     f"max({c}) {over} AS {c}_roll{w}_max", f"round(stddev_samp({c}) {over}, 7) AS {c}_roll{w}_std"]
    return ", ".join(cols)


@query("e2_rolling", f"SELECT turbine_id, ts, {_rolling_sql()} FROM t_clean")
def e2(spark, sf):
    df = clean_frame(spark, sf).select("turbine_id", "ts", *MAIN)
    out = over_slots(df, ["turbine_id"], 10, max(DERIVED.windows), 0,
                     E.rolling_stages(MAIN, DERIVED.windows)).drop(*MAIN)
    return out.withColumns({c: F.round(c, 7) for c in out.columns if c.endswith("_std")})


@query("e3_changes", """
SELECT turbine_id, ts, power - lag(power, 1) OVER w AS power_diff1, power - lag(power, 3) OVER w AS power_diff3,
  power - lag(power, 6) OVER w AS power_diff6,
  round(CASE WHEN lag(power) OVER w = 0 AND power <> 0 THEN 0 WHEN lag(power) OVER w <> 0
    THEN power / lag(power) OVER w - 1 END, 6) AS power_pctchange1
FROM t_clean WINDOW w AS (PARTITION BY turbine_id ORDER BY ts)""")
def e3(spark, sf):
    df = clean_frame(spark, sf).select("turbine_id", "ts", "power")
    out = over_slots(df, ["turbine_id"], 10, 6, 0, lambda w: E.change_columns(w, ["power"])).drop("power")
    return out.withColumn("power_pctchange1", F.round("power_pctchange1", 6))


@query("e4_calendar", """
SELECT turbine_id, ts, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
  CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM t_clean""")
def e4(spark, sf):
    cols = E.calendar_columns()
    names = ["hour_of_day", "day_of_week", "month", "day_of_year", "is_weekend"]
    return clean_frame(spark, sf).select("turbine_id", "ts", *[cols[n].alias(n) for n in names])


@query("e5_cyclic", """
SELECT turbine_id, ts, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
  round(sin(2 * pi() * month(ts) / 12), 6) AS month_sin, round(cos(2 * pi() * month(ts) / 12), 6) AS month_cos,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_cos
FROM t_clean""")
def e5(spark, sf):
    cols = E.calendar_columns()
    names = [n for n in cols if n.endswith(("_sin", "_cos"))]
    return clean_frame(spark, sf).select("turbine_id", "ts", *[F.round(cols[n], 6).alias(n) for n in names])


# Orders span every month, readings only one; the season is taken over both.
@query("e6_season", """
SELECT CASE WHEN month(ts) IN (3,4,5) THEN 1 WHEN month(ts) IN (6,7,8) THEN 2
  WHEN month(ts) IN (9,10,11) THEN 3 ELSE 4 END AS season, count(*) AS n
FROM (SELECT ts FROM t_clean UNION ALL SELECT o_orderdate FROM orders) GROUP BY 1""")
def e6(spark, sf):
    dates = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderdate").alias("ts"))
    both = clean_frame(spark, sf).select("ts").union(dates)
    return both.groupBy(E.season(F.month("ts")).alias("season")).agg(F.count("*").alias("n"))


@query("e7_ramp", """
SELECT turbine_id, ts, r AS power_ramp, abs(r) AS power_ramp_abs,
  CAST(coalesce(r > 11, false) AS INTEGER) AS power_ramp_up, CAST(coalesce(r < -11, false) AS INTEGER) AS power_ramp_down
FROM (SELECT *, (power - lag(power) OVER (PARTITION BY turbine_id ORDER BY ts)) / 10 AS r FROM t_clean)""")
def e7(spark, sf):
    df = clean_frame(spark, sf).select("turbine_id", "ts", "power")
    return over_slots(df, ["turbine_id"], 10, 1, 0, lambda w: E.ramp_columns(w, ["power"], DERIVED)).drop("power")


@query("e8_interactions", """
SELECT turbine_id, c.ts, farm_avg_power, farm_avg_wind, power / nullif(wind_speed, 0) AS power_per_wind
FROM t_clean c JOIN t_farm f ON f.ts = c.ts""")
def e8(spark, sf):
    df = clean_frame(spark, sf)
    return E.with_interactions(df, C.farm_frame(df)).select(
        "turbine_id", "ts", "farm_avg_power", "farm_avg_wind", "power_per_wind")


def series_targets(spark, sf):
    """As `build_targets`; what is stored is one row per slot."""
    return S.long_targets(stage(spark, sf, "targets", lambda: slot_targets(spark, sf)))


def build_targets(spark, sf):
    """(series_id, ts, split, horizon, steps, power, y_true, roll6, flags) over turbines and farm."""
    return S.long_targets(slot_targets(spark, sf))


def slot_targets(spark, sf):
    """One row per slot with the targets of all horizons side by side."""
    series = C.series_frame(clean_frame(spark, sf), farm_flags="all")

    def columns(w):
        return {**E.target_columns(w), "roll6": F.avg("power").over(w.rowsBetween(-6, -1))}

    wide = over_slots(series, ["series_id"], 10, 6, max(HORIZONS.values()), columns)
    return S.split_by_time(wide, bounds(spark, sf), DERIVED)


@query("e9_targets", "SELECT series_id, ts, split, horizon, steps, y_true FROM t_target")
def e9(spark, sf):
    return build_targets(spark, sf).select("series_id", "ts", "split", "horizon", "steps", "y_true")


_FEATURES = ("power_lag1", "power_lag144", "wind_speed_lag12", "power_roll6_mean", "power_roll144_max",
             "temperature_roll36_min", "power_diff3", "power_ramp_abs", "hour_of_day", "power_target_24hour")


@query("e10_feature_matrix", """
SELECT turbine_id, c.ts, lag(power, 1) OVER w AS power_lag1, lag(power, 144) OVER w AS power_lag144,
  lag(wind_speed, 12) OVER w AS wind_speed_lag12,
  avg(power) OVER (PARTITION BY turbine_id ORDER BY c.ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS power_roll6_mean,
  max(power) OVER (PARTITION BY turbine_id ORDER BY c.ts ROWS BETWEEN 144 PRECEDING AND 1 PRECEDING) AS power_roll144_max,
  min(temperature) OVER (PARTITION BY turbine_id ORDER BY c.ts ROWS BETWEEN 36 PRECEDING AND 1 PRECEDING) AS temperature_roll36_min,
  power - lag(power, 3) OVER w AS power_diff3, abs(power - lag(power, 1) OVER w) / 10 AS power_ramp_abs,
  CAST(hour(c.ts) AS INTEGER) AS hour_of_day, lead(power, 144) OVER w AS power_target_24hour, farm_avg_power
FROM t_clean c JOIN t_farm f ON f.ts = c.ts WINDOW w AS (PARTITION BY turbine_id ORDER BY c.ts)""")
def e10(spark, sf):
    df = clean_frame(spark, sf)
    out = E.feature_matrix(df, C.farm_frame(df), DERIVED)
    return out.select("turbine_id", "ts", *_FEATURES, "farm_avg_power")


@query("e10_farm_scope", """
SELECT farm_no, ts, place || '_' || name AS name, value FROM (
  SELECT (CAST(substr(turbine_id, 3) AS BIGINT) - 1) // 12 AS farm_no, ts,
    'TB' || lpad(CAST((CAST(substr(turbine_id, 3) AS BIGINT) - 1) % 12 + 1 AS VARCHAR), 2, '0') AS place,
    lag(power) OVER (PARTITION BY turbine_id ORDER BY ts) AS power_lag1,
    max(power) OVER (PARTITION BY turbine_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS power_roll6_max,
    lag(wind_speed, 2) OVER (PARTITION BY turbine_id ORDER BY ts) AS wind_speed_lag2, temperature FROM t_clean)
UNPIVOT (value FOR name IN (power_lag1, power_roll6_max, wind_speed_lag2, temperature))
WHERE value IS NOT NULL AND (name LIKE 'power%' OR place IN ('TB01', 'TB02', 'TB03'))""")
def e10_farm(spark, sf):
    wide = E.farm_scope_matrix(with_farm(clean_frame(spark, sf)), PLACES, DERIVED)
    names = [c for c in wide.columns if c.endswith(("power_lag1", "power_roll6_max", "wind_speed_lag2", "_temperature"))]
    return wide.unpivot(["farm_no", "ts"], names, "name", "value").where(F.col("value").isNotNull())


def _feature_cells():
    """Every feature of the matrix as SQL, named as the matrix names it."""
    w = "OVER (PARTITION BY turbine_id ORDER BY c.ts)"
    cols = {c: c for c in SENSORS}
    cols |= {f"{c}_lag{k}": f"lag({c}, {k}) {w}" for c in MAIN for k in DERIVED.lags}
    for c in MAIN:
        for k in DERIVED.windows:
            over = f"OVER (PARTITION BY turbine_id ORDER BY c.ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
            cols |= {f"{c}_roll{k}_{n}": f"{fn}({c}) {over}"
                     for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))}
    cols |= {f"power_diff{k}": f"power - lag(power, {k}) {w}" for k in (1, 3, 6)}
    cols["power_pctchange1"] = (
        f"CASE WHEN lag(power) {w} = 0 AND power <> 0 THEN 0 WHEN lag(power) {w} <> 0 THEN power / lag(power) {w} - 1 END")
    cols |= {"power_ramp": f"power - lag(power) {w}", "power_ramp_abs": f"power - lag(power) {w}",
             "power_per_wind": "power / nullif(wind_speed, 0)"}
    always = ["power_ramp_up", "power_ramp_down", *[
        "hour_of_day", "day_of_week", "month", "day_of_year", "is_weekend", "hour_sin", "hour_cos", "month_sin", "month_cos",
        "dow_sin", "dow_cos", "season"]]
    cols |= {n: "1" for n in always}
    return cols | {"farm_avg_power": "farm_avg_power", "farm_avg_wind": "farm_avg_wind"}


def _feature_sql():
    cols = _feature_cells()
    inner = ", ".join(f"{e} AS f_{n}" for n, e in cols.items())
    counts = ", ".join(f"count(f_{n}) AS {n}" for n in cols)
    return f"""
SELECT feature, n_present, n_rows FROM (UNPIVOT (SELECT count(*) AS n_rows, {counts} FROM (
  SELECT {inner} FROM t_clean c JOIN t_farm f ON f.ts = c.ts)) ON {", ".join(cols)} INTO NAME feature VALUE n_present)"""


cte("t_complete", f"""
SELECT turbine_id, ts FROM (SELECT turbine_id, c.ts, {", ".join(f"{e} AS f_{n}" for n, e in _feature_cells().items())}
  FROM t_clean c JOIN t_farm f ON f.ts = c.ts)
WHERE {" AND ".join(f"f_{n} IS NOT NULL" for n in _feature_cells())}
""")


@query("e11_feature_columns", _feature_sql())
def e11(spark, sf):
    df = clean_frame(spark, sf)
    matrix = E.feature_matrix(df, C.farm_frame(df), DERIVED)
    chosen = E.select_feature_columns(matrix)
    counts = matrix.agg(*[F.count(c).alias(c) for c in chosen], F.count("*").alias("_rows"))
    return counts.unpivot(["_rows"], chosen, "feature", "n_present").withColumnRenamed("_rows", "n_rows")


@query("e12_training_frame", """
SELECT series_id, horizon, split, count(*) AS n_rows, count(*) FILTER (power IS NOT NULL AND wind_speed IS NOT NULL
  AND roll6 IS NOT NULL AND y_true IS NOT NULL) AS n_complete,
  sum(coalesce(power, 0)) AS filled_power FROM t_target GROUP BY ALL""")
def e12(spark, sf):
    rows = series_targets(spark, sf)
    keys = ["series_id", "horizon", "split"]
    complete = E.training_frame(rows, ["power", "wind_speed", "roll6"], "y_true").groupBy(*keys).agg(
        F.count("*").alias("n_complete"))
    filled = E.filled_features(rows, ["power"]).groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum("power").alias("filled_power"))
    return filled.join(complete, keys, "left").fillna(0, ["n_complete"])


@query("e13_feature_scores", """
SELECT series_id, horizon, feature, n, round(r, 6) AS r, round(r * r / (1 - r * r) * (n - 2), 3) AS f_score FROM (
  UNPIVOT (SELECT series_id, horizon, count(*) AS n, corr(power, y_true) AS power, corr(wind_speed, y_true) AS wind_speed,
    corr(roll6, y_true) AS roll6 FROM t_target WHERE split = 'train' AND power IS NOT NULL
    AND wind_speed IS NOT NULL AND roll6 IS NOT NULL AND y_true IS NOT NULL GROUP BY series_id, horizon)
  ON power, wind_speed, roll6 INTO NAME feature VALUE r)""")
def e13(spark, sf):
    rows = series_targets(spark, sf).where("split = 'train'")
    out = E.univariate_scores(rows, ["power", "wind_speed", "roll6"], "y_true", ["series_id", "horizon"])
    return out.withColumns({"r": F.round("r", 6), "f_score": F.round("f_score", 3)})


@query("e14_scale", """
SELECT s.series_id, s.ts, round((power - pm) / ps, 6) AS power, round((wind_speed - wm) / ws, 6) AS wind_speed
FROM t_split s LEFT JOIN (SELECT series_id, avg(power) AS pm, stddev_pop(power) AS ps, avg(wind_speed) AS wm,
  stddev_pop(wind_speed) AS ws FROM t_split WHERE split = 'train' GROUP BY series_id) p ON p.series_id = s.series_id""")
def e14(spark, sf):
    series = S.split_by_time(C.series_frame(clean_frame(spark, sf), "all"), bounds(spark, sf), DERIVED)
    out = E.scale(series, series.where("split = 'train'"), ["power", "wind_speed"])
    return out.select("series_id", "ts", F.round("power", 6).alias("power"), F.round("wind_speed", 6).alias("wind_speed"))


def weather_rows(spark, sf):
    """Weather forecasts read off the farm's own later readings at three leads, with repeats."""
    farm = C.farm_frame(clean_frame(spark, sf)).where(F.col("farm_avg_wind_speed").isNotNull())
    leads = farm.select("*", F.explode(F.array(F.lit(60), F.lit(360), F.lit(1440))).alias("lead_minutes"))
    return leads.select(
        (F.col("ts") - F.make_dt_interval(mins=F.col("lead_minutes"))).alias("timestamp"), "lead_minutes",
        F.col("farm_avg_wind_speed").alias("wind_speed"),
        (F.floor(F.col("farm_avg_wind_speed") * 16) % 360).cast("double").alias("wind_direction"),
        F.lit(10.0).alias("temperature"),
    )


@query("e15_weather", """
SELECT turbine_id, c.ts, f.farm_avg_wind AS nwp_wind_speed,
  CAST(CAST(floor(f.farm_avg_wind * 16) AS BIGINT) % 360 AS DOUBLE) AS nwp_wind_direction,
  CASE WHEN f.farm_avg_wind IS NOT NULL THEN 10::DOUBLE END AS nwp_temperature
FROM t_clean c LEFT JOIN (SELECT ts, farm_avg_wind FROM t_farm WHERE farm_avg_wind IS NOT NULL) f
  ON f.ts = c.ts + INTERVAL '60 minutes'""")
def e15(spark, sf):
    weather = weather_rows(spark, sf)
    out = E.add_weather(clean_frame(spark, sf), weather.union(weather.where("lead_minutes = 60")), 60)
    return out.select("turbine_id", "ts", "nwp_wind_speed", "nwp_wind_direction", "nwp_temperature")


# ---- splits

@query("f1_split_by_time", "SELECT series_id, ts, split FROM t_split")
def f1(spark, sf):
    series = C.series_frame(clean_frame(spark, sf), "all")
    return S.split_by_time(series, bounds(spark, sf), DERIVED).select("series_id", "ts", "split")


@query("f1_split_by_rows", """
SELECT r.turbine_id, r.ts, reading_no, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM t_raw r JOIN (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts FROM t_raw)) p ON p.ts = r.ts""")
def f1_rows(spark, sf):
    return S.split_by_rows(readings(spark, sf), DERIVED).select("turbine_id", "ts", "reading_no", "split")


def split_turbines(spark, sf):
    return S.split_by_time(clean_frame(spark, sf), bounds(spark, sf), DERIVED)


@query("f2_split_statistics", """
SELECT part, count(*) AS rows, min(ts) AS timestamp_start, max(ts) AS timestamp_end,
  date_diff('minute', min(ts), max(ts)) // 10 + 1 AS expected_steps, count(*) AS unique_timestamps,
  CAST(0 AS BIGINT) AS n_duplicate_timestamps,
  greatest(0, date_diff('minute', min(ts), max(ts)) // 10 + 1 - count(*)) AS n_missing_timestamps,
  CAST(count(*) AS DOUBLE) / (date_diff('minute', min(ts), max(ts)) // 10 + 1) AS coverage_ratio,
  round(sum(p) / sum(np), 6) AS avg_power, round(sum(p) * 10 / 60000, 6) AS total_energy_mwh,
  round(sum(p) / sum(np) * (SELECT count(DISTINCT turbine_id) FROM t_raw) * 10 / 60000, 6) AS avg_slot_energy_mwh,
  CAST(sum(o) AS BIGINT) AS n_observed_rows, CAST(sum(1 - o) AS BIGINT) AS n_synthetic_rows,
  CAST(sum(i) AS BIGINT) AS n_imputed_rows, count(*) FILTER (o = 1 AND i = 0) AS n_observed_not_imputed_rows,
  round(avg(o), 6) AS observed_ratio
FROM (SELECT unnest([split, 'total']) AS part, ts, p, np, o, i FROM (
  SELECT split, ts, sum(power) AS p, count(power) AS np, max(is_observed) AS o, max(is_imputed) AS i
  FROM t_split WHERE series_id <> 'farm_total_power' GROUP BY split, ts)) GROUP BY part""")
def f2(spark, sf):
    out = S.split_statistics(split_turbines(spark, sf), farm_settings(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in (
        "avg_power", "total_energy_mwh", "avg_slot_energy_mwh", "observed_ratio")})


@query("f3_horizon_counts", """
SELECT series_id, split, horizon, count(*) AS n_rows, count(y_true) AS n_valid_targets,
  count(*) - count(y_true) AS n_invalid_targets, count(y_true) / count(*) AS ratio_valid
FROM t_target GROUP BY ALL""")
def f3(spark, sf):
    return S.horizon_counts(series_targets(spark, sf))


@query("f4_horizon_valid_samples", """
SELECT split, horizon, avg(n) AS avg_valid, min(n) AS min_valid, max(n) AS max_valid FROM (
  SELECT series_id, split, horizon, count(y_true) AS n FROM t_target WHERE series_id <> 'farm_total_power' GROUP BY ALL)
GROUP BY ALL""")
def f4(spark, sf):
    return S.horizon_valid_samples(series_targets(spark, sf).where("series_id <> 'farm_total_power'"))


@query("f5_time_index", "SELECT series_id, ts, pos AS time_index FROM t_split")
def f5(spark, sf):
    series = C.series_frame(clean_frame(spark, sf), "all")
    return S.add_time_index(series, bounds(spark, sf), DERIVED).select("series_id", "ts", "time_index")


@query("f6_walk_forward", """
SELECT series_id, CAST(fold AS INTEGER) AS fold, part, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, sum(power) AS power FROM (
  SELECT s.*, fold, CASE WHEN pos < greatest(floor(n * (0.25::DOUBLE + (fold - 1) * 0.12::DOUBLE)), 100) THEN 'train'
    WHEN pos < floor(n * (0.25::DOUBLE + fold * 0.12::DOUBLE)) THEN 'validation'
    WHEN pos < floor(n * (0.25::DOUBLE + (fold + 1) * 0.12::DOUBLE)) THEN 'test' END AS part
  FROM t_split s CROSS JOIN (SELECT unnest(range(1, 6)) AS fold))
WHERE part IS NOT NULL GROUP BY ALL""")
def f6(spark, sf):
    series = C.series_frame(clean_frame(spark, sf), "all")
    return S.walk_forward(series, bounds(spark, sf), DERIVED).groupBy("series_id", "fold", "part").agg(
        F.count("*").alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum("power").alias("power"))


@query("f7_cv_folds", """
SELECT series_id, CAST(fold AS INTEGER) AS fold, part, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM (
  SELECT s.*, fold, CASE WHEN pos < n - (n // 4) * (4 - fold) THEN 'train'
    WHEN pos < n - (n // 4) * (3 - fold) THEN 'test' END AS part
  FROM t_split s CROSS JOIN (SELECT unnest(range(1, 4)) AS fold))
WHERE part IS NOT NULL GROUP BY ALL""")
def f7(spark, sf):
    series = C.series_frame(clean_frame(spark, sf), "all")
    return S.cv_folds(series, bounds(spark, sf), 3, DERIVED).groupBy("series_id", "fold", "part").agg(
        F.count("*").alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("f8_official_window", """
SELECT split, count(*) FILTER (is_simulated = 0) AS kept, count(*) FILTER (is_simulated = 1) AS excluded,
  (SELECT count(*) FROM t_split WHERE split = 'test' AND is_simulated = 0 AND series_id <> 'farm_total_power') AS official_rows
FROM t_split WHERE series_id <> 'farm_total_power' GROUP BY split""")
def f8(spark, sf):
    rows = split_turbines(spark, sf)
    official = S.official_window(rows.where("split = 'test'"), DERIVED).agg(F.count("*")).scalar()
    return S.official_window_counts(rows).withColumn("official_rows", official)
