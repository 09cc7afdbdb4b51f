"""Shared pieces of the oracle SQL: each entry is one common table expression."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def with_ctes(body: str) -> str:
    """Prefix a statement with the common table expressions it reaches, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in CTES if n in needed]
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join([*parts, body[15:]])
    if parts and body.startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


cte("t_raw", """
SELECT printf('TB%05d', user_id // 30 + 1) AS turbine_id,
       time_bucket(INTERVAL '10 minutes', ts) AS ts,
       event_id % 2 AS reading_no,
       CAST(sum(c) FILTER (event_type IN ('view', 'click', 'signup'))
            // (16 * count(c) FILTER (event_type IN ('view', 'click', 'signup'))) AS DOUBLE) / 32 AS wind_speed,
       CAST(sum(c) FILTER (event_type IN ('error', 'click', 'signup'))
            // (16 * count(c) FILTER (event_type IN ('error', 'click', 'signup'))) AS DOUBLE) / 16 - 15 AS temperature,
       CAST(sum(c) FILTER (event_type IN ('purchase', 'signup', 'click')) AS DOUBLE) / 4 - 40 AS power,
       CAST(sum(c) // (64 * count(c)) AS DOUBLE) / 16 + 46 AS frequency
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)
GROUP BY 1, 2, 3
""")
cte("t_first", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY turbine_id, ts ORDER BY reading_no) AS rn FROM t_raw)
WHERE rn = 1
""")
cte("t_clip", """
SELECT turbine_id, ts,
       CASE WHEN wind_speed IS NOT NULL THEN least(greatest(wind_speed, 0.0::DOUBLE), 60.0::DOUBLE) END AS wind_speed,
       CASE WHEN temperature IS NOT NULL THEN least(greatest(temperature, (-10.0)::DOUBLE), 55.0::DOUBLE) END AS temperature,
       CASE WHEN power IS NOT NULL THEN least(greatest(power, 0.0::DOUBLE), 2200.0::DOUBLE) END AS power,
       CASE WHEN frequency IS NOT NULL THEN least(greatest(frequency, 47.0::DOUBLE), 53.0::DOUBLE) END AS frequency
FROM t_first
""")
cte("t_grid", """
SELECT g.turbine_id, g.ts, c.wind_speed, c.temperature, c.power, c.frequency,
       CASE WHEN c.ts IS NULL THEN 0 ELSE 1 END AS is_observed,
       CASE WHEN c.ts IS NULL THEN 1 ELSE 0 END AS is_synthetic
FROM (SELECT turbine_id, s.ts
      FROM (SELECT DISTINCT turbine_id FROM t_raw)
      CROSS JOIN (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL '10 minutes')) AS ts FROM t_raw) s) g
LEFT JOIN t_clip c ON c.turbine_id = g.turbine_id AND c.ts = g.ts
""")
cte("t_filled", """
SELECT turbine_id, ts, is_observed, is_synthetic,
       CAST(wind_speed IS NULL AS INTEGER) AS wind_speed_missing,
       CAST(temperature IS NULL AS INTEGER) AS temperature_missing,
       CAST(power IS NULL AS INTEGER) AS power_missing,
       CAST(frequency IS NULL AS INTEGER) AS frequency_missing,
       w AS wind_speed, t AS temperature, p AS power, f AS frequency,
       CAST((wind_speed IS NULL AND w IS NOT NULL) OR (temperature IS NULL AND t IS NOT NULL)
         OR (power IS NULL AND p IS NOT NULL) OR (frequency IS NULL AND f IS NOT NULL) AS INTEGER) AS is_imputed
FROM (SELECT *,
        last_value(wind_speed IGNORE NULLS) OVER w12 AS w,
        last_value(temperature IGNORE NULLS) OVER w12 AS t,
        last_value(power IGNORE NULLS) OVER w12 AS p,
        last_value(frequency IGNORE NULLS) OVER w12 AS f
      FROM t_grid
      WINDOW w12 AS (PARTITION BY turbine_id ORDER BY ts ROWS BETWEEN 12 PRECEDING AND CURRENT ROW))
""")
cte("t_clean", """
SELECT *,
       CASE WHEN wind_speed > 25 THEN 'curtailed' WHEN power >= 50 THEN 'generating'
            WHEN power > 0 THEN 'partial_load' WHEN power = 0 THEN 'stopped'
            WHEN power IS NULL AND wind_speed IS NOT NULL THEN 'stopped'
            WHEN wind_speed IS NULL THEN 'no_data' ELSE 'unknown' END AS status,
       CAST(ts >= (SELECT least(TIMESTAMP '2024-01-29', max(ts)) FROM t_raw) AS INTEGER) AS is_simulated
FROM t_filled
""")
cte("t_bounds", "SELECT min(ts) AS lo, max(ts) AS hi, date_diff('minute', min(ts), max(ts)) // 10 + 1 AS n FROM t_raw")
cte("t_farm", """
SELECT ts, sum(power) AS farm_total_power, avg(power) AS farm_avg_power, avg(wind_speed) AS farm_avg_wind
FROM t_clean GROUP BY ts
""")
cte("t_series", """
SELECT turbine_id AS series_id, ts, power, wind_speed, is_observed, is_imputed, is_simulated FROM t_clean
UNION ALL
SELECT 'farm_total_power', ts, sum(power), avg(wind_speed), max(is_observed), min(is_imputed), max(is_simulated)
FROM t_clean GROUP BY ts
""")
cte("t_split", """
SELECT s.*, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train'
                 WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT t_series.*, n, date_diff('minute', lo, ts) // 10 AS pos FROM t_series, t_bounds) s
""")
cte("t_horizon", """
SELECT * FROM (VALUES ('10min', 1), ('30min', 3), ('1hour', 6), ('6hour', 36), ('24hour', 144)) v(horizon, steps)
""")
cte("t_target", """
SELECT s.series_id, s.ts, s.power, s.wind_speed, s.is_observed, s.is_imputed, s.is_simulated, s.split, s.pos,
       h.horizon, h.steps, f.power AS y_true, s.roll6
FROM (SELECT *, avg(power) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS roll6
      FROM t_split) s
CROSS JOIN t_horizon h
LEFT JOIN t_series f ON f.series_id = s.series_id AND f.ts = s.ts + h.steps * INTERVAL '10 minutes'
""")

cte("t_rated", "SELECT 2200.0::DOUBLE * count(DISTINCT turbine_id) AS farm_rated FROM t_raw")
cte("t_fit", """
SELECT series_id, horizon, count(*) AS n, avg(y_true) AS y_mean,
  avg(power) AS x_mean, stddev_pop(power) AS x_std, covar_pop(power, y_true) AS xy,
  regr_slope(y_true, wind_speed) AS wind_slope, regr_intercept(y_true, wind_speed) AS wind_intercept,
  regr_slope(y_true, roll6) AS roll_slope, regr_intercept(y_true, roll6) AS roll_intercept
FROM t_target WHERE split = 'train' AND power IS NOT NULL AND wind_speed IS NOT NULL AND roll6 IS NOT NULL
  AND y_true IS NOT NULL GROUP BY ALL
""")
cte("t_pred", """
SELECT t.*, m.model, CASE m.model WHEN 'persistence' THEN power
    WHEN 'ridge' THEN y_mean + (n * xy / x_std / (n + 1.0::DOUBLE)) * (power - x_mean) / x_std
    WHEN 'linear_wind' THEN wind_intercept + wind_slope * wind_speed
    ELSE roll_intercept + roll_slope * roll6 END AS y_pred,
  CASE WHEN t.series_id = 'farm_total_power' THEN farm_rated ELSE 2200.0::DOUBLE END AS rated
FROM t_target t JOIN t_fit f ON f.series_id = t.series_id AND f.horizon = t.horizon
CROSS JOIN (VALUES ('persistence'), ('ridge'), ('linear_wind'), ('linear_roll')) m(model)
CROSS JOIN t_rated
""")
cte("t_test", """
SELECT * FROM t_pred WHERE split = 'test' AND is_observed = 1 AND is_imputed = 0 AND is_simulated = 0
  AND y_true IS NOT NULL AND y_pred IS NOT NULL
""")
cte("t_metrics", """
SELECT series_id, horizon, model, avg(abs(y_pred - y_true)) AS mae, sqrt(avg((y_pred - y_true) ** 2)) AS rmse,
  avg(abs(y_pred - y_true)) / min(rated) * 100 AS nmae_pct, sqrt(avg((y_pred - y_true) ** 2)) / min(rated) * 100 AS nrmse_pct,
  avg(y_pred - y_true) AS bias, 1 - sum((y_pred - y_true) ** 2) / (var_pop(y_true) * count(*)) AS r2,
  max(abs(y_pred - y_true)) AS max_error, count(*) AS n_samples
FROM t_test GROUP BY ALL
""")
