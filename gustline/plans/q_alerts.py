"""Registered queries of screening, states, accuracy and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustline.operators import alerts as J
from gustline.operators import diagnostics as D
from gustline.operators import splits as S
from gustline.operators.boosting import MODULUS, draw_sql
from gustline.plans.q_clean import clean_frame
from gustline.plans.q_features import bounds, series_targets
from gustline.plans.q_scores import metrics, rounded, test_predictions
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.settings import SENSORS
from gustline.sources.derived import DERIVED, PLACES, with_farm

SCREEN = "'heuristic_screening' AS method, false AS confirmed, 'SCREENING_ONLY' AS verification_status"

cte("t_ramps", """
SELECT turbine_id, ts, CASE WHEN change > 0 THEN 'ramp_up' ELSE 'ramp_down' END AS ramp_type, change AS expected_change,
  least(1.0::DOUBLE, abs(change / 10) / 0.5::DOUBLE) AS probability, 0.1::DOUBLE AS threshold
FROM (SELECT *, (power - lag(power) OVER (PARTITION BY turbine_id ORDER BY ts)) / 1000 AS change FROM t_clean)
WHERE abs(change / 10) > 0.1::DOUBLE
""")
cte("t_profile", """
SELECT c.*, abs(power - m) / (s + 1e-6::DOUBLE) AS z FROM t_clean c JOIN (
  SELECT turbine_id, avg(power) AS m, stddev_pop(power) AS s FROM t_clean WHERE power IS NOT NULL AND wind_speed IS NOT NULL
  GROUP BY turbine_id HAVING count(*) >= 100) p ON p.turbine_id = c.turbine_id
WHERE power IS NOT NULL AND wind_speed IS NOT NULL
""")
cte("t_anomalies", """
SELECT * FROM (SELECT turbine_id, ts, round(z, 6) AS anomaly_score, CASE WHEN power < 0 THEN 'Negative power output (possible motoring)'
    WHEN power > 2200 THEN 'Power exceeds rated capacity' WHEN wind_speed < 3 AND power > 500 THEN 'High power at low wind speed'
    WHEN wind_speed > 15 AND power < 200 THEN 'Low power at high wind speed' WHEN z > 2.5 THEN 'Statistical anomaly' END AS evidence,
  'power_output' AS suspected_component FROM t_profile) WHERE evidence IS NOT NULL
""")
cte("t_warnings", """
SELECT turbine_id, ts, temperature, w.warning_type, w.severity FROM (
  SELECT *, unnest([
    CASE WHEN temperature >= 50 THEN {'warning_type': 'high_temperature', 'severity': 'critical'}
         WHEN temperature >= 45 THEN {'warning_type': 'high_temperature', 'severity': 'warning'} END,
    CASE WHEN temperature <= -15 THEN {'warning_type': 'low_temperature', 'severity': 'critical'}
         WHEN temperature <= -10 THEN {'warning_type': 'low_temperature', 'severity': 'warning'} END,
    CASE WHEN abs(temperature - prior) >= 5 THEN {'warning_type': 'rapid_temp_change', 'severity': 'warning'} END,
    CASE WHEN temperature >= 40 AND run = 3 THEN {'warning_type': 'sustained_high_temp', 'severity': 'warning'} END]) AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY turbine_id, misses ORDER BY ts) - CASE WHEN misses = 0 THEN 0 ELSE 1 END AS run
    FROM (SELECT turbine_id, ts, temperature, lag(temperature) OVER s AS prior,
        sum(CASE WHEN temperature >= 40 THEN 0 ELSE 1 END) OVER s AS misses
      FROM t_clean WINDOW s AS (PARTITION BY turbine_id ORDER BY ts))) WHERE temperature IS NOT NULL)
WHERE w IS NOT NULL
""")
cte("t_risks", """
SELECT turbine_id, ts, stop_count, least(0.85::DOUBLE, 0.3::DOUBLE + stop_count * 0.05::DOUBLE) AS stop_risk_score
FROM (SELECT *, sum(CASE WHEN power < 10 THEN 1 ELSE 0 END) OVER (PARTITION BY turbine_id, misses ORDER BY ts)::BIGINT AS stop_count
  FROM (SELECT c.turbine_id, ts, power, sum(CASE WHEN power < 10 THEN 0 ELSE 1 END) OVER (PARTITION BY c.turbine_id ORDER BY ts) AS misses
    FROM t_clean c JOIN (SELECT turbine_id FROM t_clean WHERE power IS NOT NULL GROUP BY turbine_id
      HAVING count(*) >= 100 AND avg(power) > 500) r ON r.turbine_id = c.turbine_id WHERE power IS NOT NULL))
WHERE stop_count > 3
""")


@query("j1_ramp_alerts", f"""
SELECT turbine_id, ts, ramp_type, expected_change, round(probability, 6) AS probability, threshold, {SCREEN} FROM t_ramps""")
def j1(spark, sf):
    return J.ramp_alerts(clean_frame(spark, sf), DERIVED).withColumn("probability", F.round("probability", 6))


@query("j2_anomaly_alerts", f"SELECT *, {SCREEN} FROM t_anomalies")
def j2(spark, sf):
    return rounded(J.anomaly_alerts(clean_frame(spark, sf), DERIVED), 6)


@query("j3_temperature_warnings", f"SELECT *, {SCREEN} FROM t_warnings")
def j3(spark, sf):
    return J.temperature_warnings(clean_frame(spark, sf), DERIVED)


@query("j4_failure_risk", f"""
SELECT turbine_id, ts, stop_count, round(stop_risk_score, 6) AS stop_risk_score, 'general' AS component,
  '24hour' AS horizon, {SCREEN} FROM t_risks""")
def j4(spark, sf):
    return rounded(J.failure_risk(clean_frame(spark, sf), DERIVED), 6)


@query("j5_screening_summary", " UNION ALL ".join(
    f"SELECT '{n}' AS alert_table, count(*) AS n_rows, true AS heuristic, 'SCREENING_ONLY' AS status FROM {t}"
    for n, t in (("ramp_alert", "t_ramps"), ("anomaly_alert", "t_anomalies"),
                 ("temperature_warning", "t_warnings"), ("failure_risk", "t_risks"))))
def j5(spark, sf):
    df = clean_frame(spark, sf)
    return J.screening_summary({
        "ramp_alert": J.ramp_alerts(df, DERIVED), "anomaly_alert": J.anomaly_alerts(df, DERIVED),
        "temperature_warning": J.temperature_warnings(df, DERIVED), "failure_risk": J.failure_risk(df, DERIVED)})


cte("t_residual", """
SELECT r.*, CASE WHEN s > 0 THEN abs(residual - m) / s ELSE 0 END AS score FROM (
  SELECT c.turbine_id, ts, power, wind_speed, power - CASE WHEN n > 10 THEN i + k * coalesce(wind_speed, 0) ELSE a END AS residual
  FROM t_clean c JOIN (SELECT turbine_id, count(*) FILTER (power IS NOT NULL AND wind_speed IS NOT NULL) AS n,
    regr_slope(power, wind_speed) AS k, regr_intercept(power, wind_speed) AS i, avg(power) AS a FROM t_clean GROUP BY turbine_id) f
    ON f.turbine_id = c.turbine_id) r
JOIN (SELECT c.turbine_id, avg(power - CASE WHEN n > 10 THEN i + k * coalesce(wind_speed, 0) ELSE a END) AS m,
    stddev_pop(power - CASE WHEN n > 10 THEN i + k * coalesce(wind_speed, 0) ELSE a END) AS s
  FROM t_clean c JOIN (SELECT turbine_id, count(*) FILTER (power IS NOT NULL AND wind_speed IS NOT NULL) AS n,
    regr_slope(power, wind_speed) AS k, regr_intercept(power, wind_speed) AS i, avg(power) AS a FROM t_clean GROUP BY turbine_id) f
    ON f.turbine_id = c.turbine_id GROUP BY c.turbine_id) q ON q.turbine_id = r.turbine_id
""")


@query("j6_residual_anomalies", """
SELECT turbine_id, ts, power, wind_speed, round(residual, 5) AS residual, round(score, 6) AS anomaly_score,
  CAST(coalesce(score > 3, false) AS INTEGER) AS is_anomaly FROM t_residual""")
def j6(spark, sf):
    out = J.residual_anomalies(clean_frame(spark, sf))
    return out.withColumns({"residual": F.round("residual", 5), "anomaly_score": F.round("anomaly_score", 6)})


def isolation_sql(trees=100, sample=256, seed=42):
    """Common table expressions that grow the forest level by level over t_iso (farm_no, ts, x) and the scores of all rows (iso_scores)."""
    cte("iso_draw", f"""
SELECT *, {draw_sql('k', 'tree', seed)} AS h
FROM (SELECT *, CAST(('0x' || substr(md5(farm_no || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 12)) AS BIGINT) AS k FROM t_iso)
CROSS JOIN (SELECT unnest(range({trees})) AS tree)""")
    cte("iso_at0", f"SELECT *, 1 AS node, row_number() OVER (PARTITION BY tree ORDER BY h, k) <= {sample} AS inside FROM iso_draw")

    for level in range(D.LEVELS):
        cte(f"iso_box{level}", f"""
SELECT tree, node, n, list_filter([0, 1, 2], lambda f: hi[f + 1] > lo[f + 1]) AS free, lo, hi FROM (
  SELECT tree, node, count(*) AS n, [min(x[1]), min(x[2]), min(x[3])] AS lo, [max(x[1]), max(x[2]), max(x[3])] AS hi
  FROM iso_at{level} WHERE inside AND node >= {1 << level} GROUP BY tree, node)""")
        cte(f"iso_cut{level}", f"""
SELECT tree, node, f, lo[f + 1] + (hi[f + 1] - lo[f + 1]) * ({draw_sql('2 * node + 1', 'tree', seed + 3)} / {MODULUS}::DOUBLE) AS threshold
FROM (SELECT *, free[{draw_sql('2 * node', 'tree', seed + 3)} * len(free) // {MODULUS} + 1] AS f FROM iso_box{level} WHERE len(free) > 0)""")
        cte(f"iso_at{level + 1}", f"""
SELECT a.* REPLACE (CASE WHEN c.f IS NULL THEN a.node ELSE 2 * a.node + CAST(x[c.f + 1] > threshold AS INTEGER) END AS node)
FROM iso_at{level} a LEFT JOIN iso_cut{level} c ON c.tree = a.tree AND c.node = a.node""")
    path = "CASE WHEN s <= 1 THEN 0 WHEN s = 2 THEN 1 ELSE 2 * (ln(s - 1) + 0.5772156649015329::DOUBLE) - 2 * (s - 1) / s::DOUBLE END"
    cte("iso_scores", f"""
SELECT farm_no, ts, pow(2.0::DOUBLE, -(sum(length(bin(node)) - 1 + {path}) / {trees}) / (SELECT {path} FROM (SELECT avg(n) AS s FROM iso_box0))) AS score
FROM (SELECT a.*, coalesce(s, 0)::DOUBLE AS s FROM iso_at{D.LEVELS} a LEFT JOIN (SELECT tree, node, count(*) AS s FROM iso_at{D.LEVELS} WHERE inside GROUP BY tree, node) l
  ON l.tree = a.tree AND l.node = a.node) GROUP BY farm_no, ts""")


cte("t_iso", """
SELECT farm_no, ts, [coalesce(max(wind_speed) FILTER (place = 1), 0.0::DOUBLE), coalesce(max(wind_speed) FILTER (place = 2), 0.0::DOUBLE),
  coalesce(max(wind_speed) FILTER (place = 3), 0.0::DOUBLE)] AS x
FROM (SELECT *, (CAST(substr(turbine_id, 3) AS BIGINT) - 1) // 12 AS farm_no, (CAST(substr(turbine_id, 3) AS BIGINT) - 1) % 12 + 1 AS place FROM t_clean)
GROUP BY farm_no, ts
""")
isolation_sql()


@query("j7_isolation_forest", """
SELECT farm_no, ts, round(score, 9) AS isolation_score, CAST(round(score, 9) > (SELECT round(quantile_cont(score, 0.95), 9) FROM iso_scores) AS INTEGER) AS isolation_anomaly
FROM iso_scores""")
def j7(spark, sf):
    """On the wind readings of the first three turbines of each farm, side by side."""
    first = PLACES[:3]
    wide = with_farm(clean_frame(spark, sf)).groupBy("farm_no", "ts").pivot("place", first).agg(F.first("wind_speed"))
    return D.isolation_scores(wide, first, ["farm_no", "ts"]).withColumn("isolation_score", F.round("isolation_score", 9))


@query("j8_anomaly_counts", """
SELECT turbine_id, CAST(sum(CAST(coalesce(score > 3, false) AS INTEGER)) AS BIGINT) AS n_anomalies,
  round(avg(CAST(coalesce(score > 3, false) AS INTEGER)) * 100, 6) AS pct FROM t_residual GROUP BY turbine_id""")
def j8(spark, sf):
    return rounded(J.anomaly_counts(J.residual_anomalies(clean_frame(spark, sf))), 6)


cte("t_stops", """
SELECT turbine_id, ts, power, CAST(low = 1 AND count(*) OVER (PARTITION BY turbine_id, low, g) >= 3 AS INTEGER) AS failure_event,
  CAST(low = 1 AND count(*) OVER (PARTITION BY turbine_id, low, g) >= 3
    AND row_number() OVER (PARTITION BY turbine_id, low, g ORDER BY ts) = 1 AS INTEGER) AS event_start
FROM (SELECT *, row_number() OVER (PARTITION BY turbine_id ORDER BY ts) - row_number() OVER (PARTITION BY turbine_id, low ORDER BY ts) AS g
  FROM (SELECT turbine_id, ts, power, CASE WHEN power < 5 THEN 1 ELSE 0 END AS low FROM t_clean))
""")


@query("j9_stop_events", "SELECT * FROM t_stops")
def j9(spark, sf):
    return J.stop_events(clean_frame(spark, sf), DERIVED)


@query("j10_stop_summary", """
SELECT turbine_id, CAST(sum(failure_event) AS BIGINT) AS failure_slots, CAST(sum(event_start) AS BIGINT) AS n_events,
  round(sum(failure_event) * 10 / 60, 6) AS failure_hours FROM t_stops GROUP BY turbine_id""")
def j10(spark, sf):
    return rounded(J.stop_summary(J.stop_events(clean_frame(spark, sf), DERIVED), DERIVED), 6)


cte("t_state", """
SELECT *, CASE WHEN power IS NULL THEN 'missing/unknown' WHEN power > 5 THEN 'generating' WHEN status = 'curtailed' THEN 'curtailed'
  WHEN wind_speed IS NULL THEN 'communication_loss' WHEN wind_speed > 3 THEN 'standby' ELSE 'stopped' END AS state,
  CASE WHEN power IS NULL THEN 'missing/unknown' WHEN power > 5 THEN 'generating' WHEN status = 'curtailed' THEN 'curtailed'
  WHEN status = 'no_data' THEN 'communication_loss' WHEN wind_speed > 3 THEN 'standby' ELSE 'stopped' END AS legacy_state
FROM t_clean
""")


@query("j11_states", "SELECT turbine_id, ts, state, legacy_state FROM t_state")
def j11(spark, sf):
    return clean_frame(spark, sf).select(
        "turbine_id", "ts", J.operating_state().alias("state"), J.operating_state(True).alias("legacy_state"))


@query("j12_availability", """
SELECT turbine_id, round(n / 6, 6) AS total_hours, round(g / 6, 6) AS generating_hours, round(s / 6, 6) AS stopped_hours,
  round(c / 6, 6) AS curtailed_hours, round(b / 6, 6) AS standby_hours, round(l / 6, 6) AS comm_loss_hours,
  round(m / 6, 6) AS missing_hours, round(coalesce(g * 100 / nullif(g + s + c + b, 0), 0), 6) AS observed_availability_pct,
  round(g * 100 / n, 6) AS calendar_availability_pct, round((g + s + c + b) * 100 / n, 6) AS data_coverage_pct
FROM (SELECT turbine_id, count(*) AS n, count(*) FILTER (state = 'generating') AS g, count(*) FILTER (state = 'stopped') AS s,
  count(*) FILTER (state = 'curtailed') AS c, count(*) FILTER (state = 'standby') AS b,
  count(*) FILTER (state = 'communication_loss') AS l, count(*) FILTER (state = 'missing/unknown') AS m FROM t_state GROUP BY turbine_id)""")
def j12(spark, sf):
    return rounded(J.availability(clean_frame(spark, sf), DERIVED), 6)


def confusion_sql(extra=""):
    return f"""round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(fp / nullif(fp + tp, 0), 0), 6) AS false_discovery_rate,
  round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS false_alarm_rate, round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS specificity,
  round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy,
  round(coalesce((tp + fn) / nullif(tp + fp + fn + tn, 0), 0), 6) AS prevalence{extra}"""


def ramp_sql(truth, align):
    return f"""
SELECT series_id, horizon, model, tp + fn AS n_actual_events, tp + fp AS n_predicted_events, tp, fp, fn, tn, {confusion_sql()},
  '{align}' AS alignment FROM (
  SELECT series_id, horizon, model, count(*) FILTER (e AND a) AS tp, count(*) FILTER (NOT e AND a) AS fp,
    count(*) FILTER (e AND NOT a) AS fn, count(*) FILTER (NOT e AND NOT a) AS tn
  FROM (SELECT series_id, horizon, model, coalesce(abs({truth} - lag({truth}) OVER w) / 2200 * 100 > 0.5, false) AS e,
      coalesce(abs(y_pred - lag(y_pred) OVER w) / 2200 * 100 > 0.5, false) AS a
    FROM t_pred WHERE split = 'test' AND series_id <> 'farm_total_power'
    WINDOW w AS (PARTITION BY series_id, horizon, model ORDER BY ts)) GROUP BY ALL)"""


def turbine_predictions(spark, sf):
    return test_predictions(spark, sf).where("split = 'test' and series_id <> 'farm_total_power'")


@query("j13_ramp_accuracy", ramp_sql("y_true", "target"))
def j13(spark, sf):
    return rounded(J.ramp_accuracy(turbine_predictions(spark, sf), DERIVED), 6)


@query("j13_ramp_accuracy_at_issue", ramp_sql("power", "issue"))
def j13_issue(spark, sf):
    return rounded(J.ramp_accuracy(turbine_predictions(spark, sf), DERIVED, align="issue"), 6)


@query("j14_anomaly_accuracy", f"""
SELECT turbine_id, tp + fn AS n_gt_anomalies, tp + fp AS n_detected, tp, fp, fn, tn, gp AS gt_power_anomalies,
  dp AS detected_power_anomalies, gw AS gt_wind_curve_anomalies, dw AS detected_wind_curve_anomalies, {confusion_sql()},
  round(coalesce(dp / nullif(tp, 0), 0), 6) AS power_anomaly_precision,
  round(coalesce(dw / nullif(tp, 0), 0), 6) AS wind_curve_anomaly_precision
FROM (SELECT turbine_id, count(*) FILTER ((p OR w) AND d) AS tp, count(*) FILTER (NOT (p OR w) AND d) AS fp,
    count(*) FILTER ((p OR w) AND NOT d) AS fn, count(*) FILTER (NOT (p OR w) AND NOT d) AS tn, count(*) FILTER (p) AS gp,
    count(*) FILTER (p AND d) AS dp, count(*) FILTER (w) AS gw, count(*) FILTER (w AND d) AS dw
  FROM (SELECT c.turbine_id, coalesce(c.power < 0 OR c.power > 2200, false) AND c.wind_speed IS NOT NULL AS p,
      coalesce(NOT (c.power < 0 OR c.power > 2200) AND ((c.wind_speed < 3 AND c.power > 1760) OR (c.wind_speed > 15 AND c.power < 220)), false) AS w,
      coalesce(z > 3, false) AS d
    FROM t_clean c LEFT JOIN t_profile f ON f.turbine_id = c.turbine_id AND f.ts = c.ts
    WHERE c.turbine_id IN (SELECT turbine_id FROM t_profile)) GROUP BY turbine_id)""")
def j14(spark, sf):
    return rounded(J.anomaly_accuracy(clean_frame(spark, sf), DERIVED), 6)


def frozen_sql(source, keys):
    """Recursive scan (scan) and its result (frozen) of frozen runs within the given keys."""
    names, same = ", ".join(keys), " AND ".join(f"v.{k} = s.{k}" for k in keys)
    row = ", ".join(f"v.{k}" for k in keys)
    stays = "coalesce(abs(v.power - anchor) < 1, false)"
    ends, last = f"NOT {stays} AND len >= 5 AND first < v.n - 5", "len >= 5 AND first < n - 5"
    return f"""
v AS (SELECT {names}, power, row_number() OVER (PARTITION BY {names} ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY {names}) AS n FROM {source}),
scan AS (
  SELECT {names}, pos, n, power AS anchor, CASE WHEN power IS NULL THEN 0 ELSE 1 END AS len, pos AS first, 0 AS blocks, 0 AS samples
  FROM v WHERE pos = 0
  UNION ALL
  SELECT {row}, v.pos, v.n, CASE WHEN {stays} THEN anchor ELSE v.power END,
    CASE WHEN {stays} THEN len + 1 WHEN v.power IS NULL THEN 0 ELSE 1 END, CASE WHEN {stays} THEN first ELSE v.pos END,
    blocks + CASE WHEN {ends} THEN 1 ELSE 0 END, samples + CASE WHEN {ends} THEN len ELSE 0 END
  FROM scan s JOIN v ON {same} AND v.pos = s.pos + 1),
frozen AS (SELECT {names}, CAST(blocks + CASE WHEN {last} THEN 1 ELSE 0 END AS BIGINT) AS frozen_blocks,
  CAST(samples + CASE WHEN {last} THEN len ELSE 0 END AS BIGINT) AS frozen_samples, n AS n_rows,
  CAST(samples + CASE WHEN {last} THEN len ELSE 0 END AS DOUBLE) / n AS frozen_ratio FROM scan WHERE pos = n - 1)"""


@query("j15_frozen_runs", f"WITH RECURSIVE {frozen_sql('t_clean', ['turbine_id'])} SELECT * FROM frozen")
def j15(spark, sf):
    return D.frozen_runs(clean_frame(spark, sf), settings=DERIVED)


def split_frame(spark, sf):
    return S.split_by_time(with_farm(clean_frame(spark, sf)), bounds(spark, sf), DERIVED)


cte("t_parts", """
SELECT c.*, s.split, (CAST(substr(turbine_id, 3) AS BIGINT) - 1) // 12 AS farm_no
FROM t_clean c JOIN t_split s ON s.series_id = c.turbine_id AND s.ts = c.ts
""")
cte("t_near", """
SELECT a.turbine_id, a.split, b.turbine_id AS other_id, count(*) FILTER (a.power IS NOT NULL AND b.power IS NOT NULL) AS n_shared,
  corr(a.power, b.power) AS power_corr, corr(CASE WHEN a.power IS NOT NULL THEN a.wind_speed END, b.wind_speed) AS wind_corr,
  avg(b.power) AS mean_power
FROM t_parts a JOIN t_parts b ON b.farm_no = a.farm_no AND b.ts = a.ts AND b.turbine_id <> a.turbine_id
GROUP BY a.turbine_id, a.split, b.turbine_id HAVING count(*) FILTER (a.power IS NOT NULL AND b.power IS NOT NULL) > 10
""")
PROFILE_SQL = f"""WITH RECURSIVE {frozen_sql('t_parts', ['turbine_id', 'split'])},
profile AS (SELECT turbine_id, split, count(*) AS n_rows, """ + ", ".join(
    f"avg(CAST({s} IS NULL AS INTEGER)) * 100 AS missing_rate_{s}" for s in SENSORS) + """,
  count(*) FILTER (power < 5) * 100 / count(*) AS stopped_rate_pct, avg(power) AS mean_power_kw,
  stddev_pop(power) FILTER (power > 5) AS std_power_operating, avg(power) FILTER (power > 5) AS mean_power_operating,
  corr(power, wind_speed) AS wind_power_corr, avg(wind_speed) AS mean_wind_speed
FROM t_parts GROUP BY turbine_id, split)"""
PROFILE_COLUMNS = [*[f"missing_rate_{s}" for s in SENSORS], "stopped_rate_pct", "mean_power_kw", "std_power_operating",
                   "mean_power_operating", "wind_power_corr", "mean_wind_speed"]


@query("j16_turbine_profile", PROFILE_SQL + f"""
SELECT p.turbine_id, p.split, p.n_rows, {", ".join(f"round({c}, 6) AS {c}" for c in PROFILE_COLUMNS)},
  frozen_blocks, round(frozen_ratio * 100, 6) AS frozen_ratio_pct
FROM profile p JOIN frozen f ON f.turbine_id = p.turbine_id AND f.split = p.split""")
def j16(spark, sf):
    return rounded(D.turbine_profile(split_frame(spark, sf), DERIVED), 6)


@query("j16_effective_samples", """
SELECT series_id, split, horizon, count(y_true) AS effective_samples, count(*) - count(y_true) AS invalid_targets
FROM t_target GROUP BY ALL""")
def j16_samples(spark, sf):
    return D.effective_samples(series_targets(spark, sf))


@query("j16_neighbour_correlations", """
SELECT turbine_id, split, other_id, n_shared, round(power_corr, 6) AS power_corr, round(wind_corr, 6) AS wind_corr,
  round(mean_power, 6) AS mean_power FROM t_near""")
def j16_neighbours(spark, sf):
    return rounded(D.neighbour_correlations(split_frame(spark, sf)), 6)


@query("j16_findings", PROFILE_SQL + """,
found AS (SELECT p.turbine_id, p.split, (SELECT avg(power_corr) FROM t_near n WHERE n.turbine_id = p.turbine_id AND n.split = p.split) AS near,
    missing_rate_power, frozen_ratio, wind_power_corr, stopped_rate_pct, mean_power_kw
  FROM profile p JOIN frozen f ON f.turbine_id = p.turbine_id AND f.split = p.split)
SELECT f.turbine_id, split, round(near, 6) AS mean_neighbour_corr, round(mean_r2, 4) AS mean_r2,
  coalesce(nullif(concat_ws('; ', CASE WHEN missing_rate_power > 20 THEN 'HIGH_MISSING' END,
    CASE WHEN frozen_ratio * 100 > 10 THEN 'FROZEN_SIGNAL' END, CASE WHEN wind_power_corr < 0.5 THEN 'LOW_WS_POWER_CORR' END,
    CASE WHEN near < 0.4 THEN 'LOW_NEIGHBOR_CORR' END, CASE WHEN stopped_rate_pct > 30 THEN 'HIGH_STOPPED' END,
    CASE WHEN mean_power_kw < 200 THEN 'LOW_MEAN_POWER' END), ''), 'NO_ANOMALY_DETECTED') AS findings
FROM found f LEFT JOIN (SELECT series_id, avg(r2) AS mean_r2 FROM t_metrics GROUP BY series_id) m ON m.series_id = f.turbine_id""")
def j16_findings(spark, sf):
    rows = split_frame(spark, sf)
    out = D.turbine_findings(D.turbine_profile(rows, DERIVED), D.neighbour_correlations(rows), metrics(spark, sf))
    return out.select("turbine_id", "split", F.round("mean_neighbour_corr", 6).alias("mean_neighbour_corr"),
                      F.round("mean_r2", 4).alias("mean_r2"), "findings")


@query("j17_risk_matrix", """
SELECT turbine_id, date_trunc('day', ts)::TIMESTAMP AS day, round(avg(stop_risk_score), 6) AS mean_score FROM t_risks GROUP BY ALL""")
def j17(spark, sf):
    return rounded(J.risk_matrix(J.failure_risk(clean_frame(spark, sf), DERIVED)), 6)


@query("j18_ramp_head", """
SELECT turbine_id, ts, expected_change FROM t_ramps ORDER BY ts, turbine_id LIMIT 500""")
def j18(spark, sf):
    ramps = J.ramp_alerts(clean_frame(spark, sf), DERIVED).select("turbine_id", "ts", "expected_change")
    return J.head(ramps, ["ts", "turbine_id"], 500)
