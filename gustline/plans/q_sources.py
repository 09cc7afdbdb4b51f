"""Registered queries of sources, schema mapping, validation and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.timeline import slot_of, slot_start
from gustline.operators import audits as K
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.operators import models as G
from gustline.operators import quality as Q
from gustline.operators import scoring as I
from gustline.plans.q_alerts import j1, j2, j3, j4
from gustline.plans.q_clean import clean_frame, farm_settings, unique_frame
from gustline.plans.q_features import series_targets, weather_rows
from gustline.plans.q_models import TREE_FEATURES, forest_registry
from gustline.plans.q_scores import forecasts, metrics, official, predictions, rounded
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.session import shared_dir
from gustline.settings import HORIZONS, SENSORS
from gustline.sources import headers as B
from gustline.sources import readers as A
from gustline.sources.derived import DERIVED, PLACES, readings, with_farm


def scratch(spark, name):
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}-{name}"


# ---- sources

@query("a1_read_parquet", "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts IS NOT NULL")
def a1(spark, sf):
    return A.read_one(spark, f"{sf}/events.parquet")


@query("a1_read_csv", "SELECT turbine_id, ts, power, wind_speed FROM t_first")
def a1_csv(spark, sf):
    path = scratch(spark, "readings.csv")
    rows = unique_frame(spark, sf).select("turbine_id", F.col("ts").cast("string").alias("ts"), "power", "wind_speed")
    broken = rows.limit(1).withColumn("ts", F.lit("not a time"))
    rows.union(broken).write.option("header", True).csv(path)
    return A.read_one(spark, path)


@query("a1_read_json", "SELECT turbine_id, ts, power, wind_speed FROM t_first")
def a1_json(spark, sf):
    path = scratch(spark, "readings.json")
    rows = unique_frame(spark, sf).select("turbine_id", F.col("ts").cast("string").alias("ts"), "power", "wind_speed")
    rows.write.json(path)
    schema = T.StructType([T.StructField("turbine_id", T.StringType()), T.StructField("ts", T.StringType()),
                           T.StructField("power", T.DoubleType()), T.StructField("wind_speed", T.DoubleType())])
    df = spark.read.schema(schema).json(path)
    return df.withColumn("ts", A.as_timestamp(F.col("ts"), "string")).dropna(subset=["ts"])


def two_inputs(spark, sf):
    """Readings stored as two overlapping inputs of different formats; the second differs where both have a row."""
    rows = unique_frame(spark, sf).select("turbine_id", "ts", "power", "wind_speed")
    root = scratch(spark, "raw")
    early, late = f"{root}/01-early.parquet", f"{root}/02-late.csv"
    rows.where(F.dayofmonth("ts") <= 20).write.parquet(early)
    rows.where(F.dayofmonth("ts") >= 10).withColumn("power", F.col("power") + 1000).write.option("header", True).csv(late)
    return root, [late, early]


@query("a2_read_all_first_wins", """
SELECT turbine_id, ts, CASE WHEN day(ts) <= 20 THEN power ELSE power + 1000 END AS power, wind_speed FROM t_first""")
def a2(spark, sf):
    return A.read_all(spark, two_inputs(spark, sf)[1], ["turbine_id", "ts"])


@query("a3_load_weather", """
SELECT ts - lead * INTERVAL '1 minute' AS timestamp, CAST(lead AS BIGINT) AS lead_minutes, farm_avg_wind AS wind_speed,
  CAST(CAST(floor(farm_avg_wind * 16) AS BIGINT) % 360 AS DOUBLE) AS wind_direction, 10.0::DOUBLE AS temperature
FROM t_farm CROSS JOIN (VALUES (60), (360), (1440)) l(lead) WHERE farm_avg_wind IS NOT NULL""")
def a3(spark, sf):
    path = scratch(spark, "weather.csv")
    weather_rows(spark, sf).write.option("header", True).csv(path)
    return A.load_weather(spark, path)


@query("a4_write_and_read", "SELECT turbine_id, ts, power, wind_speed, CAST(2024 AS INTEGER) AS year FROM t_clean")
def a4(spark, sf):
    path = scratch(spark, "processed")
    A.save_processed(clean_frame(spark, sf).select("turbine_id", "ts", "power", "wind_speed"), path)
    return A.load_processed(spark, path).where("year = 2024")


@query("a5_file_manifest")
def a5(spark, sf):
    return A.file_manifest(spark, [f"{sf}/events.parquet"])


@query("a5_file_coverage", """
SELECT 'events.parquet' AS file_name, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM events""")
def a5_coverage(spark, sf):
    return A.file_coverage(spark, [f"{sf}/events.parquet"])


# One user's day stands for one file.
@query("a6_overlapping_files", """
WITH f AS (SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS file_name, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1)
SELECT a.file_name, a.first_ts, a.last_ts, count(b.file_name) AS overlapping_files
FROM f a LEFT JOIN f b ON b.file_name <> a.file_name AND a.first_ts <= b.last_ts AND b.first_ts <= a.last_ts GROUP BY ALL""")
def a6(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    name = F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd"))
    return A.overlapping_windows(events.groupBy(name.alias("file_name")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


@query("a7_preview", "SELECT * FROM t_raw ORDER BY ts, turbine_id, reading_no LIMIT 100")
def a7(spark, sf):
    return A.preview(readings(spark, sf), ["ts", "turbine_id", "reading_no"], 100)


_SUMMARY = [("turbine_id", "string"), ("ts", "timestamp_ntz"), ("reading_no", "bigint"), ("wind_speed", "double"),
            ("temperature", "double"), ("power", "double"), ("frequency", "double")]


@query("a8_summary", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{t}' AS type, count(*) - count({c}) AS null_count, count(*) AS n_rows,
  (count(*) - count({c})) * 100 / count(*) AS null_pct, min(ts) AS first_ts, max(ts) AS last_ts FROM t_raw"""
    for c, t in _SUMMARY))
def a8(spark, sf):
    return A.summarise(readings(spark, sf))


@query("a9_repair_swapped_days", """
SELECT turbine_id, ts, day(ts) <= 12 AND day(ts) <> 1 AS day_swapped FROM t_first""")
def a9(spark, sf):
    rows = unique_frame(spark, sf).select("turbine_id", "ts")
    t = F.col("ts")
    misread = F.when(F.dayofmonth(t) <= 12, F.make_timestamp_ntz(
        F.year(t), F.dayofmonth(t), F.month(t), F.hour(t), F.minute(t), F.lit(0).cast("decimal(16,6)"))).otherwise(t)
    return A.repair_swapped_days(rows.withColumn("ts", misread), F.lit("01.2024-01.2024"))


EDITS = [
    {"condition_column": "turbine_id", "condition_value": "TB00001", "target_column": "power", "new_value": 5.0},
    {"condition_column": "power", "condition_value": "5.0", "target_column": "wind_speed", "new_value": 1.0},
    {"condition_column": "turbine_id", "condition_value": "TB00001", "target_column": "power", "new_value": 7.0},
    {"condition_column": "turbine_id", "condition_value": "nobody", "target_column": "power", "new_value": 0.0},
    {"condition_column": "turbine_id", "condition_value": "TB00001", "target_column": "absent", "new_value": 0.0},
]


@query("a10_edits", """
SELECT turbine_id, ts, CASE WHEN turbine_id = 'TB00001' THEN 7 ELSE power END AS power,
  CASE WHEN turbine_id = 'TB00001' OR power = 5 THEN 1 ELSE wind_speed END AS wind_speed FROM t_first""")
def a10(spark, sf):
    return A.apply_edits(unique_frame(spark, sf).select("turbine_id", "ts", "power", "wind_speed"), EDITS)[0]


@query("a10_edit_log", """
SELECT CAST(edit AS INTEGER) AS edit, n_matched, CASE WHEN n_matched > 0 THEN NULL WHEN edit = 4 THEN 'column ''absent'' not found'
  ELSE 'no rows matched' END AS reason, n_matched > 0 AS applied
FROM (SELECT 0 AS edit, count(*) FILTER (turbine_id = 'TB00001') AS n_matched FROM t_first
  UNION ALL SELECT 1, count(*) FILTER (turbine_id = 'TB00001' OR power = 5) FROM t_first
  UNION ALL SELECT 2, count(*) FILTER (turbine_id = 'TB00001') FROM t_first
  UNION ALL SELECT 3, 0 UNION ALL SELECT 4, 0)""")
def a10_log(spark, sf):
    return A.apply_edits(unique_frame(spark, sf).select("turbine_id", "ts", "power", "wind_speed"), EDITS)[1]


@query("a10_edit_table", """
SELECT turbine_id, t.ts, coalesce(e.v, t.power) AS power FROM t_first t LEFT JOIN (
  SELECT ts, arg_max(value, event_id) AS v FROM (SELECT time_bucket(INTERVAL '10 minutes', ts) AS ts, value, event_id FROM events
    WHERE event_type = 'error') GROUP BY ts) e ON e.ts = t.ts""")
def a10_table(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").where("event_type = 'error'")
    edits = events.select(slot_start(slot_of(F.col("ts"), 10), 10).alias("ts"), F.col("event_id").alias("position"),
                          F.col("value").alias("new_value"))
    rows = unique_frame(spark, sf).select("turbine_id", "ts", "power")
    return A.apply_edit_table(rows, edits, ["ts"], "power")


@query("a11_check_input", """
SELECT count(*) AS n_rows, count(*) FILTER (event_id % 10 <> 0) AS n_present, count(*) FILTER (event_id % 10 = 0) AS n_corrupt,
  false AS is_valid FROM events""")
def a11(spark, sf):
    path = scratch(spark, "lines.json")
    events = spark.read.parquet(f"{sf}/events.parquet")
    line = F.when(F.col("event_id") % 10 == 0, F.rtrim("props", F.lit("}"))).otherwise(F.col("props"))
    events.select(line.alias("value")).write.text(path)
    return A.check_input(spark, path, T.StructType([T.StructField("k", T.LongType())]))


# ---- schema mapping

RAW_NAMES = {"wind_speed": "Ambient WindSpeed Avg. (13)", "temperature": "Ambient Temp. Avg. (2)",
             "power": "Grid Production Power Avg. (3)", "frequency": "Grid Production Frequency Avg. (4)"}

cte("t_place", """
SELECT *, (CAST(substr(turbine_id, 3) AS BIGINT) - 1) // 12 AS farm_no,
  'TB' || lpad(CAST((CAST(substr(turbine_id, 3) AS BIGINT) - 1) % 12 + 1 AS VARCHAR), 2, '0') AS place FROM t_clean
""")
cte("t_places", """
SELECT 'TB' || lpad(CAST(i AS VARCHAR), 2, '0') AS place, s AS sensor, h, u, coalesce(n, 0) AS n, r FROM (SELECT unnest(range(1, 13)) AS i)
CROSS JOIN (VALUES ('wind_speed', 'Ambient WindSpeed Avg. (13)', 'm/s'), ('temperature', 'Ambient Temp. Avg. (2)', '°C'),
  ('power', 'Grid Production Power Avg. (3)', 'kW'), ('frequency', 'Grid Production Frequency Avg. (4)', 'Hz')) v(s, h, u)
CROSS JOIN (SELECT count(*) AS r FROM (SELECT DISTINCT farm_no, ts FROM t_place))
LEFT JOIN (UNPIVOT (SELECT place AS p, count(wind_speed) AS wind_speed, count(temperature) AS temperature, count(power) AS power,
    count(frequency) AS frequency FROM t_place GROUP BY 1) ON wind_speed, temperature, power, frequency INTO NAME q VALUE n) c
  ON c.p = 'TB' || lpad(CAST(i AS VARCHAR), 2, '0') AND c.q = s
""")


def raw_wide(spark, sf):
    """The turbines of each farm side by side under raw headers, with a stale duplicate of one sensor per turbine."""
    rows = with_farm(clean_frame(spark, sf)).select("farm_no", "place", "ts", *SENSORS)
    wide = B.long_to_wide(rows, PLACES, by=["farm_no"], column="place")
    cells = ["farm_no", F.col("timestamp").alias(B.TIMESTAMP_HEADER)]
    for t in PLACES:
        cells.append(F.lit(-1.0).alias(f"{t}_Ambient WindSpeed Avg. (1)"))
        cells += [F.col(f"{t}_{s}").alias(f"{t}_{text}") for s, text in RAW_NAMES.items()]
    return wide.select(*cells)


@query("b1_standard_headers", "SELECT place || '_' || sensor AS name, n FROM t_places")
def b1(spark, sf):
    df = B.standardise(raw_wide(spark, sf))
    names = [c for c in df.columns if c not in ("timestamp", "farm_no")]
    counts = df.agg(F.lit(1).alias("_k"), *[F.count(c).alias(c) for c in names])
    return counts.unpivot(["_k"], names, "name", "n").drop("_k")


@query("b2_wide_to_long", """
SELECT farm_no, place AS turbine_id, ts, wind_speed, temperature, power, frequency FROM t_place
WHERE coalesce(wind_speed, temperature, power, frequency) IS NOT NULL""")
def b2(spark, sf):
    long = B.wide_to_long(B.standardise(raw_wide(spark, sf)), keep=["farm_no"])
    return long.where(F.coalesce(*SENSORS).isNotNull())


@query("b4_data_dictionary", """
SELECT place || '_' || h AS original_column, place || '_' || sensor AS standardized_name, place AS turbine_id,
  sensor AS measurement_type, u AS unit, 'double' AS data_type, r - n AS null_count, (r - n) * 100 / r AS null_pct,
  CASE sensor WHEN 'power' THEN 'target' WHEN 'frequency' THEN 'auxiliary' ELSE 'feature' END AS role FROM t_places
UNION ALL SELECT 'PCTimeStamp', 'timestamp', '', 'unknown', 'unknown', 'timestamp_ntz', 0, 0, 'auxiliary'
UNION ALL SELECT 'farm_no', 'farm_no', '', 'unknown', 'unknown', 'bigint', 0, 0, 'auxiliary'""")
def b4(spark, sf):
    return B.data_dictionary(raw_wide(spark, sf))


@query("b5_parse_target", """
SELECT series_id || CASE WHEN series_id = 'farm_total_power' THEN '' ELSE '_power' END || '_target_' || horizon AS target,
  CASE WHEN series_id = 'farm_total_power' THEN series_id ELSE series_id || '_power' END AS base_column,
  CASE WHEN series_id = 'farm_total_power' THEN 'farm_total' ELSE series_id END AS series, horizon, count(*) AS n
FROM t_target GROUP BY ALL""")
def b5(spark, sf):
    base = F.when(F.col("series_id") == "farm_total_power", F.col("series_id")).otherwise(F.concat("series_id", F.lit("_power")))
    named = series_targets(spark, sf).select(F.concat(base, F.lit("_target_"), "horizon").alias("target"))
    counts = named.groupBy("target").agg(F.count("*").alias("n"))
    return counts.withColumns(B.parse_target(F.col("target")))


# ---- validation and coverage

@query("c1_check_timestamps", """
SELECT turbine_id, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_timestamps, count(*) - count(DISTINCT ts) AS duplicate_timestamps,
  count(*) FILTER (gap <> 10) AS unusual_intervals, min(gap) AS min_interval, max(gap) AS max_interval, avg(gap) AS mean_interval
FROM (SELECT *, date_diff('minute', lag(ts) OVER (PARTITION BY turbine_id ORDER BY ts), ts) AS gap FROM t_raw) GROUP BY turbine_id""")
def c1(spark, sf):
    return Q.check_timestamps(readings(spark, sf), DERIVED)


def _sensor_sql(limits, source="t_raw"):
    rows = " UNION ALL ".join(
        f"SELECT turbine_id, '{s}' AS sensor, {s} AS value, {limits[s][0]}::DOUBLE AS lo, {limits[s][1]}::DOUBLE AS hi FROM {source}"
        for s in SENSORS)
    return f"({rows})"


@query("c2_check_ranges", f"""
SELECT *, out_of_range_count * 100 / n_values AS out_of_range_pct FROM (
  SELECT turbine_id, sensor, count(*) FILTER (value < lo OR value > hi) AS out_of_range_count, count(value) AS n_values,
    min(value) AS min_value, max(value) AS max_value FROM {_sensor_sql(Q.REPORT_LIMITS)} GROUP BY ALL) WHERE out_of_range_count > 0""")
def c2(spark, sf):
    return Q.check_ranges(readings(spark, sf))


@query("c3_check_missing", f"""
SELECT *, null_count * 100 / n_rows AS null_pct FROM (SELECT turbine_id, sensor, count(*) AS n_rows, count(*) - count(value) AS null_count
  FROM {_sensor_sql(Q.REPORT_LIMITS)} GROUP BY ALL) WHERE null_count > 0""")
def c3(spark, sf):
    return Q.check_missing(readings(spark, sf))


@query("c4_check_power", """
SELECT turbine_id, count(*) FILTER (power < 0) AS negative_power, count(*) FILTER (wind_speed > 25 AND power > 100) AS high_wind_anomaly
FROM t_raw GROUP BY turbine_id""")
def c4(spark, sf):
    return Q.check_power(readings(spark, sf))


@query("c5_run_validation", f"""
SELECT category, count(*) AS n_issues, CAST(sum(n) AS BIGINT) AS n_rows FROM (
  SELECT 'value_range' AS category, count(*) FILTER (value < lo OR value > hi) AS n FROM {_sensor_sql(Q.REPORT_LIMITS)} GROUP BY turbine_id, sensor
  UNION ALL SELECT 'missing_data', count(*) - count(value) FROM {_sensor_sql(Q.REPORT_LIMITS)} GROUP BY turbine_id, sensor
  UNION ALL SELECT 'timestamp', count(*) - count(DISTINCT ts) FROM t_raw GROUP BY turbine_id
  UNION ALL SELECT 'timestamp', count(*) FILTER (gap <> 10) FROM (SELECT turbine_id,
    date_diff('minute', lag(ts) OVER (PARTITION BY turbine_id ORDER BY ts), ts) AS gap FROM t_raw) GROUP BY turbine_id
  UNION ALL SELECT 'power_consistency', count(*) FILTER (power < 0) FROM t_raw GROUP BY turbine_id
  UNION ALL SELECT 'power_consistency', count(*) FILTER (wind_speed > 25 AND power > 100) FROM t_raw GROUP BY turbine_id)
WHERE n > 0 GROUP BY category""")
def c5(spark, sf):
    return Q.issue_counts(Q.run_validation(readings(spark, sf), DERIVED))


@query("c6_timestamp_union", "SELECT DISTINCT ts FROM t_raw")
def c6(spark, sf):
    return Q.timestamp_union(readings(spark, sf))


# Orders span seven years; readings one month.
@query("c7_coverage_audit", """
SELECT label, n_rows, n_duplicate_rows, timestamp_start, timestamp_end, expected_steps,
  greatest(0, expected_steps - n_rows) AS n_missing_timestamps, n_rows / expected_steps AS coverage_ratio
FROM (SELECT CASE WHEN y IS NULL THEN 'overall' WHEN m IS NULL THEN 'year_' || y ELSE 'month_' || y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') END AS label,
    count(*) AS n_rows,
    CAST(sum(c - 1) AS BIGINT) AS n_duplicate_rows, min(ts) AS timestamp_start, max(ts) AS timestamp_end,
    date_diff('minute', min(ts), max(ts)) // 10 + 1 AS expected_steps
  FROM (SELECT ts, year(ts) AS y, month(ts) AS m, count(*) AS c FROM (SELECT ts FROM t_raw UNION ALL SELECT o_orderdate FROM orders) GROUP BY ts)
  GROUP BY GROUPING SETS ((), (y), (y, m)))""")
def c7(spark, sf):
    dates = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderdate").alias("ts"))
    return Q.coverage_audit(readings(spark, sf).select("ts").union(dates), DERIVED)


@query("c8_synthetic_report", """
WITH a AS (SELECT DISTINCT ts FROM t_clean WHERE ts NOT IN (SELECT ts FROM t_raw))
SELECT (SELECT count(*) FROM a) AS n_added, (SELECT count(*) FROM a) / (SELECT count(DISTINCT ts) FROM t_clean) AS ratio,
  (SELECT string_agg(strftime(ts, '%Y-%m-%d %H:%M'), ', ' ORDER BY ts) FROM (SELECT ts FROM a ORDER BY ts LIMIT 5)) AS examples""")
def c8(spark, sf):
    return Q.synthetic_report(readings(spark, sf), clean_frame(spark, sf))


QUALITY_SQL = f"""
SELECT turbine_id || '_' || sensor AS "column", (count(*) - count(value)) * 100 / count(*) AS missing_rate_pct,
  count(*) FILTER (value < lo OR value > hi) AS invalid_values, min(value) AS min, max(value) AS max,
  CASE sensor WHEN 'power' THEN 'kW' WHEN 'wind_speed' THEN 'm/s' WHEN 'temperature' THEN 'degC' ELSE 'Hz' END AS unit,
  CASE WHEN (count(*) - count(value)) * 100 / count(*) > 50 THEN 'High missing rate - investigate'
    WHEN (count(*) - count(value)) * 100 / count(*) > 20 THEN 'Significant missing data'
    WHEN (count(*) - count(value)) * 100 / count(*) > 10 THEN 'Moderate missing data'
    WHEN count(*) > count(value) THEN 'Minor gaps' ELSE 'Complete' END AS remarks
FROM {_sensor_sql(Q.CLIP_LIMITS, "t_clean")} GROUP BY turbine_id, sensor"""


@query("c9_quality_report", f"""
SELECT *, 'missing_rate = null count after the fill / rows * 100' AS definition,
  'cleaned table, after the fill, before features' AS data_source FROM ({QUALITY_SQL}
UNION ALL SELECT 'farm_total_power', (count(*) - count(farm_total_power)) * 100 / count(*),
  count(*) FILTER (farm_total_power < 0 OR farm_total_power > farm_rated), min(farm_total_power), max(farm_total_power), 'kW',
  CASE WHEN count(*) = count(farm_total_power) THEN 'Complete' ELSE 'Minor gaps' END FROM t_farm, t_rated
UNION ALL SELECT 'missing flag columns', NULL, 0, 0, 1, 'binary', 'Captured before the fill')""")
def c9(spark, sf):
    df = clean_frame(spark, sf)
    return Q.quality_report(df, C.farm_frame(df), farm_settings(spark, sf))


@query("c10_missing_extremes", f"""
WITH q AS (SELECT replace("column", '_wind_speed', '') AS t, * FROM ({QUALITY_SQL}) WHERE "column" LIKE '%_wind_speed')
SELECT a.t AS lowest, a.missing_rate_pct AS lowest_pct, a.remarks AS lowest_remarks, b.t AS highest,
  b.missing_rate_pct AS highest_pct, b.remarks AS highest_remarks
FROM (SELECT * FROM q ORDER BY missing_rate_pct, t LIMIT 1) a, (SELECT * FROM q ORDER BY missing_rate_pct DESC, t DESC LIMIT 1) b""")
def c10(spark, sf):
    df = clean_frame(spark, sf)
    return Q.missing_extremes(Q.quality_report(df, C.farm_frame(df), farm_settings(spark, sf)))


CONTRACT = {
    "evaluation_metrics": ("series_id", "horizon", "model", "mae", "rmse", "r2", "n_samples"),
    "power_forecast": ("ts", "series_id", "horizon", "model", "predicted"),
    "coverage": ("nominal_confidence", "empirical_coverage", "calibration_error"),
    "farm_metrics": ("horizon", "model", "rmse", "bias"),
}


@query("c11_output_contract", """
SELECT * FROM (VALUES ('evaluation_metrics', (SELECT count(*) FROM t_metrics), CAST(0 AS BIGINT), '', 'PASS'),
  ('power_forecast', (SELECT count(*) FROM t_fc), 0, '', 'PASS'), ('coverage', (SELECT count(*) FROM t_cov), 0, '', 'PASS'),
  ('farm_metrics', (SELECT count(*) FROM t_metrics WHERE series_id = 'farm_total_power'), 0, '', 'PASS')) v(output_table, n_rows, n_without_samples, missing_columns, status)""")
def c11(spark, sf):
    tables = {"evaluation_metrics": metrics(spark, sf), "power_forecast": forecasts(spark, sf),
              "coverage": I.coverage(official(spark, sf)),
              "farm_metrics": I.farm_metrics(official(spark, sf), I.fit_bias(predictions(spark, sf)))}
    return Q.check_contract(tables, CONTRACT)


@query("c11_coverage_gap", """
SELECT round(max(calibration_error), 6) AS max_gap, CASE WHEN max(calibration_error) <= 0.05 THEN 'PASS' ELSE 'FAIL' END AS status
FROM t_conformal""")
def c11_gap(spark, sf):
    return rounded(Q.coverage_gap_ok(I.split_conformal(official(spark, sf), DERIVED)), 6)


@query("c12_metric_grid", """
SELECT s.series_id, h.horizon, m.model FROM (SELECT DISTINCT series_id FROM t_series) s CROSS JOIN t_horizon h
CROSS JOIN (VALUES ('persistence'), ('ridge'), ('linear_wind'), ('linear_roll'), ('random_forest')) m(model)
WHERE NOT EXISTS (SELECT 1 FROM t_metrics t WHERE t.series_id = s.series_id AND t.horizon = h.horizon AND t.model = m.model)""")
def c12(spark, sf):
    series = series_targets(spark, sf).select("series_id").distinct()
    return Q.metric_grid(metrics(spark, sf), series, list(HORIZONS), [*G.BASE_MODELS, "random_forest"])


@query("c12_target_horizons", """
SELECT series_id || '_target_' || horizon AS target, 1::BIGINT AS n_horizons, true AS named_by_horizon, 'PASS' AS status
FROM t_metrics GROUP BY ALL""")
def c12_horizons(spark, sf):
    named = metrics(spark, sf).withColumn("target", F.concat("series_id", F.lit("_target_"), "horizon"))
    return Q.target_horizons(named)


# ---- audits

FEATURES_SQL = "CASE model WHEN 'linear_wind' THEN 'wind_speed' WHEN 'linear_roll' THEN 'roll6' ELSE 'power' END"
FOREST_SQL = f"""SELECT series_id, '1hour' AS horizon, 'random_forest' AS model, count(*) AS n_scored
FROM t_split WHERE series_id = 'farm_total_power' AND split = 'test' GROUP BY series_id"""


def model_registry(spark, sf):
    """Every closed-form model with the features its fit reads, and the saved forest with the features stored beside it."""
    return G.base_registry(predictions(spark, sf)).unionByName(forest_registry(spark, sf))


@query("k1_name_audit", f"""
SELECT series_id, horizon, model, count(y_pred) AS n_scored, 1 AS n_features, '' AS leaky_features, 'PASS' AS status
FROM t_pred GROUP BY ALL
UNION ALL SELECT *, {len(TREE_FEATURES)}, '', 'PASS' FROM ({FOREST_SQL})""")
def k1(spark, sf):
    return K.name_audit(model_registry(spark, sf)).drop("features", "target")


@query("k2_feature_evidence", f"""
SELECT series_id, horizon, model, count(y_pred) AS n_scored, series_id || '_target_' || horizon AS target, {FEATURES_SQL} AS feature_list,
  false AS target_in_features, false AS any_future_target FROM t_pred GROUP BY ALL
UNION ALL SELECT *, 'farm_total_power_target_1hour', '{", ".join(TREE_FEATURES)}', false, false FROM ({FOREST_SQL})""")
def k2(spark, sf):
    return K.feature_evidence(model_registry(spark, sf)).drop("features")


@query("k3_leakage_assertions", """
SELECT series_id, horizon, model, count(*) AS n_rows, true AS target_time_ok, NOT bool_and(abs(y_pred - y_true) <= 1e-8 + 1e-5 * abs(y_true)) AS prediction_differs,
  true AS target_not_in_features, true AS no_meta_column, 'PASS' AS status FROM t_pred WHERE split = 'test' GROUP BY ALL""")
def k3(spark, sf):
    rows = predictions(spark, sf).where("split = 'test'")
    series = C.series_frame(clean_frame(spark, sf), "all")
    return K.leakage_assertions(rows, series, G.base_registry(predictions(spark, sf)), DERIVED)


@query("k4_frame_audit", """
SELECT model, series_id, horizon, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_duplicate_rows, CAST(0 AS BIGINT) AS n_without_target,
  true AS target_after_issue, true AS target_not_in_features, true AS no_later_names, 'PASS' AS status
FROM t_target CROSS JOIN (VALUES ('ridge'), ('linear_wind'), ('linear_roll')) m(model)
WHERE split = 'train' AND power IS NOT NULL AND wind_speed IS NOT NULL AND roll6 IS NOT NULL AND y_true IS NOT NULL GROUP BY ALL""")
def k4(spark, sf):
    used = list(dict.fromkeys(G.BASE_FEATURES.values()))
    rows = E.training_frame(series_targets(spark, sf).where("split = 'train'"), used, "y_true")
    frame = rows.withColumn("due", F.col("ts") + F.make_dt_interval(mins=F.col("steps") * 10))
    out = None
    for model in G.BASE_ALPHAS:
        feature = G.BASE_FEATURES[model]
        own = frame.select("series_id", "horizon", "ts", "due", feature, "y_true")
        part = K.frame_audit(own, [feature], "y_true", "ts", "due", ["series_id", "horizon"], model)
        out = part if out is None else out.unionByName(part)
    return out


@query("k5_sample_trace", """
SELECT ts AS timestamp_issue, ts + INTERVAL '360 minutes' AS timestamp_target, power, power_lag1, power_lag6, wind_speed,
  y_true AS target, round(pp, 4) AS pred_persistence, round(pr, 4) AS pred_ridge
FROM (SELECT p.ts, p.power, p.wind_speed, y_true, l.l1 AS power_lag1, l.l6 AS power_lag6,
    max(y_pred) FILTER (model = 'persistence') AS pp, max(y_pred) FILTER (model = 'ridge') AS pr
  FROM t_pred p JOIN (SELECT turbine_id, ts, lag(power, 1) OVER w AS l1, lag(power, 6) OVER w AS l6 FROM t_clean
    WINDOW w AS (PARTITION BY turbine_id ORDER BY ts)) l ON l.turbine_id = p.series_id AND l.ts = p.ts
  WHERE series_id = 'TB00002' AND horizon = '6hour' AND split = 'test' GROUP BY ALL)
WHERE power IS NOT NULL AND wind_speed IS NOT NULL AND power_lag1 IS NOT NULL AND power_lag6 IS NOT NULL AND y_true IS NOT NULL
  AND pp IS NOT NULL AND pr IS NOT NULL ORDER BY ts LIMIT 200""")
def k5(spark, sf):
    features = E.window_features(clean_frame(spark, sf), DERIVED, ["power"], {})
    out = K.sample_trace(features, predictions(spark, sf).where("split = 'test'"), "TB00002", "6hour",
                         ["power", "power_lag1", "power_lag6", "wind_speed"], ["persistence", "ridge"], DERIVED)
    return out.withColumns({c: F.round(c, 4) for c in ("pred_persistence", "pred_ridge")})


@query("k6_inventory", """
SELECT 'ramp_alert' AS output_table, count(*) AS n_rows FROM t_ramps UNION ALL SELECT 'anomaly_alert', count(*) FROM t_anomalies
UNION ALL SELECT 'temperature_warning', count(*) FROM t_warnings UNION ALL SELECT 'failure_risk', count(*) FROM t_risks
UNION ALL SELECT 'power_forecast', count(*) FROM t_fc UNION ALL SELECT 'evaluation_metrics', count(*) FROM t_metrics""")
def k6(spark, sf):
    return K.inventory({
        "ramp_alert": j1(spark, sf), "anomaly_alert": j2(spark, sf), "temperature_warning": j3(spark, sf),
        "failure_risk": j4(spark, sf), "power_forecast": forecasts(spark, sf), "evaluation_metrics": metrics(spark, sf)})


@query("k6_rows_by_model", "SELECT model, count(*) AS n_rows FROM t_metrics GROUP BY model")
def k6_models(spark, sf):
    return metrics(spark, sf).groupBy("model").agg(F.count("*").alias("n_rows"))
