"""Registered queries of the fitted learners and experiments."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from gustline.operators import boosting as X
from gustline.operators import breakdowns as B
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.operators import models as G
from gustline.operators import splits as S
from gustline.operators import tiles as L
from gustline.plans.q_boost import ends, feature_names, series_rows, slots
from gustline.plans.q_clean import clean_frame, farm_settings
from gustline.plans.q_features import bounds, series_targets, weather_rows
from gustline.plans.q_scores import r4, rounded
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.plans.stages import stage, value
from gustline.session import shared_dir
from gustline.settings import FARM_SERIES, HORIZONS
from gustline.sources.derived import DERIVED, with_farm

TREE_FEATURES = ["power", "wind_speed", "power_lag1", "power_lag6", "power_lag144", "power_roll6_mean",
                 "power_roll36_std", "power_diff1", "wind_speed_lag1", "wind_speed_roll6_mean", "hour_sin", "hour_cos"]


TARGETS = {h: f"power_target_{h}" for h in HORIZONS}


def farm_rows(spark, sf):
    """Farm total with its features and targets, one row per slot, in train, validation and test parts."""
    def build():
        series = C.series_frame(clean_frame(spark, sf), "all").where(F.col("series_id") == FARM_SERIES)
        rows = E.window_features(series, DERIVED, ["power", "wind_speed"], series="series_id")
        named = rows.withColumns(E.calendar_columns()).withColumn("y_true", F.col("power_target_1hour"))
        return S.split_by_time(named, bounds(spark, sf), DERIVED)

    return stage(spark, sf, "farm_features", build)


def scored_by(spark, sf, name):
    def build():
        rows = farm_rows(spark, sf)
        model = G.fit_tree(rows.where("split = 'train'"), TREE_FEATURES, G.PRESETS[name])
        return G.fit_scores(G.predict_tree(model, rows.where("split = 'test'"), TREE_FEATURES))

    return stage(spark, sf, f"scores_{name}", build)


# The scores of tree learners have no SQL; the facts queries check what SQL can tell of the same stored tables.
FACTS_SQL = """SELECT count(*) AS n_samples, true AS errors_ordered FROM t_target
WHERE series_id = 'farm_total_power' AND horizon = '1hour' AND split = 'test' AND y_true IS NOT NULL"""


def score_facts(scores):
    return scores.select("n_samples", (F.col("mae") <= F.col("rmse")).alias("errors_ordered"))


@query("g4_random_forest")
def g4(spark, sf):
    return scored_by(spark, sf, "random_forest")


@query("g4_forest_facts", FACTS_SQL)
def g4_facts(spark, sf):
    return score_facts(scored_by(spark, sf, "random_forest"))


FOREST_KEY = "farm_1hour_forest"


def stored_forest(spark, sf):
    """Folder of the saved forest and its registry, fitted once per input."""
    def build():
        rows = farm_rows(spark, sf)
        model = G.fit_tree(rows.where("split = 'train'"), TREE_FEATURES, G.PRESETS["random_forest"])
        folder = f"{shared_dir(spark)}/models-{uuid.uuid4().hex}"
        G.save_model(spark, model, folder, FOREST_KEY, TREE_FEATURES, {
            "seed": "42", "config_hash": G.config_hash(DERIVED), "data_hash": G.data_hash(rows)})
        return model, folder

    return value(spark, sf, "forest", build)


def forest_registry(spark, sf):
    """The saved forest as a row of the model registry: features as stored, forecasts it gives for test rows."""
    folder = stored_forest(spark, sf)[1]
    model, features = G.load_model(spark, folder, FOREST_KEY)
    scored = G.predict_tree(model, farm_rows(spark, sf).where("split = 'test'"), features)
    return scored.groupBy("series_id").agg(F.count("prediction").alias("n_scored")).select(
        "series_id", F.lit("1hour").alias("horizon"), F.lit("random_forest").alias("model"), "n_scored",
        F.lit(f"{FARM_SERIES}_target_1hour").alias("target"), F.array(*[F.lit(f) for f in features]).alias("features"))


@query("g11_save_and_load", """
SELECT count(DISTINCT ts) AS n_rows, 0.0::DOUBLE AS largest_change, true AS same_config, true AS same_data FROM t_clean""")
def g11(spark, sf):
    rows = farm_rows(spark, sf)
    model, folder = stored_forest(spark, sf)
    meta = G.load_meta(spark, folder, FOREST_KEY)
    loaded, features = G.load_model(spark, folder, FOREST_KEY)
    before = G.predict_tree(model, rows, TREE_FEATURES).select("ts", F.col("prediction").alias("before"))
    after = G.predict_tree(loaded, rows, features).select("ts", F.col("prediction").alias("after"))
    return before.join(after, "ts").agg(
        F.count("*").alias("n_rows"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_change"),
        F.lit(meta["config_hash"] == G.config_hash(DERIVED)).alias("same_config"),
        F.lit(meta["data_hash"] == G.data_hash(rows)).alias("same_data"))


def turbine_rows(spark, sf):
    """Per-turbine feature rows with the targets of all horizons side by side."""
    def build():
        df = clean_frame(spark, sf)
        rows = E.feature_matrix(df, C.farm_frame(df), DERIVED)
        return S.split_by_time(rows.withColumnRenamed("turbine_id", "series_id"), bounds(spark, sf), DERIVED)

    return stage(spark, sf, "turbine_features", build)


def _features(df):
    return [f for f in E.select_feature_columns(df) if f not in ("y_true", "steps")]


CELLS_SQL = """SELECT series_id, horizon, feature_set, count(*) AS n_samples FROM t_target t
JOIN t_complete c ON c.turbine_id = t.series_id AND c.ts = t.ts CROSS JOIN (VALUES %s) v(feature_set)
WHERE split = 'test' AND y_true IS NOT NULL GROUP BY ALL"""


def cells_sql(*sets):
    """Test rows of every series, horizon and feature set: those with all features and the target."""
    return CELLS_SQL % ", ".join(f"('{name}')" for name in sets)


def cells(scores):
    return scores.select("series_id", "horizon", "feature_set", "n_samples")


def compared(spark, sf, name, asks, features=None):
    """Test scores of ridge on several feature sets, every turbine and horizon, from one pass over the training rows."""
    def build():
        rows = turbine_rows(spark, sf)
        scores = L.compare(rows, asks(_features(rows)), features or _features(rows), TARGETS)
        return scores.withColumn("nmae_pct", F.col("mae") / G.rated_power(F.col("series_id"), farm_settings(spark, sf)) * 100)

    return stage(spark, sf, name, build)


@query("g2_ridge_all_features")
def g2_all(spark, sf):
    return compared(spark, sf, "ridge_all", lambda own: [L.Ask("ridge", DERIVED.top_features)])


@query("g2_ridge_cells", cells_sql("ridge"))
def g2_cells(spark, sf):
    return cells(g2_all(spark, sf))


@query("g14_feature_count")
def g14(spark, sf):
    return compared(spark, sf, "feature_count", lambda own: [L.Ask("all", own), L.Ask("top_30", 30)])


@query("g14_feature_cells", cells_sql("all", "top_30"))
def g14_cells(spark, sf):
    return cells(g14(spark, sf))


@query("g15_block_ablation")
def g15(spark, sf):
    return compared(spark, sf, "ablation", lambda own: [L.Ask(n, b) for n, b in G.ablation_blocks(own).items()])


@query("g15_block_cells", cells_sql("all", "without_lag", "without_rolling", "without_interaction", "without_weather"))
def g15_cells(spark, sf):
    return cells(g15(spark, sf))


def ridge_two_sql(source, keys):
    """Ridge on power and wind with a penalty of 1 per key, from the rows of `source` (keys, train, power, wind_speed, y_true), scored on the rest."""
    k = ", ".join(keys)
    same = " AND ".join(f"f.{c} = r.{c}" for c in keys)
    return f"""
SELECT {", ".join("r." + c for c in keys)}, avg(abs(p - y_true)) AS mae, sqrt(avg((p - y_true) ** 2)) AS rmse,
  coalesce(1 - sum((p - y_true) ** 2) / nullif(var_pop(y_true) * count(*), 0), 0) AS r2, count(*) AS n_samples
FROM (SELECT {", ".join("r." + c for c in keys)}, y_true, ym + (b1 * d - b2 * c12) / (d * d - c12 * c12) / ps * (power - pm)
    + (b2 * d - b1 * c12) / (d * d - c12 * c12) / ws * (wind_speed - wm) AS p
  FROM {source} r JOIN (SELECT *, 1 + 1.0::DOUBLE / n AS d, cpw / ps / ws AS c12, cpy / ps AS b1, cwy / ws AS b2 FROM (
    SELECT {k}, count(*) AS n, avg(power) AS pm, avg(wind_speed) AS wm, avg(y_true) AS ym, stddev_pop(power) AS ps, stddev_pop(wind_speed) AS ws,
      covar_pop(power, wind_speed) AS cpw, covar_pop(power, y_true) AS cpy, covar_pop(wind_speed, y_true) AS cwy FROM {source} WHERE train GROUP BY {k})) f ON {same}
  WHERE NOT train) r GROUP BY {", ".join("r." + c for c in keys)}"""


cte("t_wf_two", """
SELECT t.series_id, t.horizon, CAST(fold AS INTEGER) AS fold, pos < e.train_end AS train, power, wind_speed, y_true
FROM t_target t CROSS JOIN (SELECT fold, greatest(floor(n * (0.25::DOUBLE + (fold - 1) * 0.12::DOUBLE)), 100) AS train_end,
    floor(n * (0.25::DOUBLE + fold * 0.12::DOUBLE)) AS end_ FROM (SELECT unnest(range(1, 6)) AS fold), t_bounds) e
WHERE pos < end_ AND power IS NOT NULL AND wind_speed IS NOT NULL AND y_true IS NOT NULL
""")


def walk_ends(spark, sf):
    """Ends of the training rows of the five folds and of the last validation part; consecutive folds share them."""
    n = spark.range(1).select(F.lit(slots(spark, sf)).alias("n"))
    folds = [r.f for r in n.select(F.explode(F.array(*[S.fold_ends(F.col("n"), i + 1) for i in range(5)])).alias("f")).collect()]
    return [f.train_end for f in folds] + [folds[-1].validation_end]


def walked(spark, sf, name, features):
    rows = series_rows(spark, sf)
    return stage(spark, sf, name, lambda: L.walk_forward(rows, features, TARGETS, walk_ends(spark, sf), "time_index"))


@query("g9_walk_forward_full")
def g9_full(spark, sf):
    """Persistence and ridge on the whole feature list for every series, horizon and fold."""
    return walked(spark, sf, "walk_full", feature_names(spark, sf))


@query("g9_walk_forward_full_summary")
def g9_summary(spark, sf):
    return G.walk_forward_summary(g9_full(spark, sf))


@query("g9_walk_forward_two", f"""
SELECT series_id, horizon, fold, 'ridge' AS model, {r4(("mae", "rmse", "r2"))}, n_samples FROM ({ridge_two_sql("t_wf_two", ("series_id", "horizon", "fold"))})
UNION ALL SELECT series_id, horizon, fold, 'persistence', round(avg(abs(power - y_true)), 4), round(sqrt(avg((power - y_true) ** 2)), 4),
  round(coalesce(1 - sum((power - y_true) ** 2) / nullif(var_pop(y_true) * count(*), 0), 0), 4), count(*) FROM t_wf_two WHERE NOT train GROUP BY ALL""")
def g9_two(spark, sf):
    """The same on two features, where the fits have a closed form."""
    return rounded(walked(spark, sf, "walk_two", ["power", "wind_speed"]))


cte("t_two", """
SELECT series_id, horizon, split = 'train' AS train, power, wind_speed, y_true FROM t_target
WHERE split IN ('train', 'test') AND power IS NOT NULL AND wind_speed IS NOT NULL AND y_true IS NOT NULL
""")


@query("g2_ridge_two_scores", f"""SELECT series_id, horizon, {r4(("mae", "rmse", "r2"))}, n_samples FROM ({ridge_two_sql("t_two", ("series_id", "horizon"))})""")
def g2_two(spark, sf):
    """Test scores of ridge on two features from tiles, for turbines and farm."""
    pair = ["power", "wind_speed"]
    return rounded(L.compare(series_rows(spark, sf), [L.Ask("ridge", pair)], pair, TARGETS).drop("feature_set"))


# ---- every place of a farm side by side

def places(spark, sf):
    """Places that hold a turbine in every farm of the input: the columns of the wide matrix."""
    def build():
        turbines = with_farm(clean_frame(spark, sf)).select("farm_no", "place").distinct()
        n = turbines.select("farm_no").distinct().count()
        return sorted(r.place for r in turbines.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") == n).collect())

    return value(spark, sf, "places", build)


def wide_frame(spark, sf, train=False):
    """One row per farm and slot: features of all places, and the farm's power with its targets. Not stored: a reader of few columns has the others pruned,
    and one of the training rows needs readings up to their last target only.
    """
    own = S.add_time_index(with_farm(clean_frame(spark, sf)), bounds(spark, sf), DERIVED)
    if train:
        low, high = bounds(spark, sf)
        own = own.where(F.col("time_index") < F.floor((high - low + 1) * F.lit(DERIVED.train_ratio)) + max(HORIZONS.values()))
    wide = E.farm_scope_matrix(own, places(spark, sf), DERIVED, HORIZONS)
    named = wide.withColumn("series_id", F.concat(F.lit("farm_"), "farm_no")).drop("farm_no")
    return S.split_by_time(S.add_time_index(named, bounds(spark, sf), DERIVED), bounds(spark, sf), DERIVED)


def wide_rows(spark, sf):
    """The wide frame stored, for those who read it more than once."""
    return stage(spark, sf, "wide_features", lambda: wide_frame(spark, sf))


def wide_features(rows):
    return [f for f in E.select_feature_columns(rows) if not f.startswith("power_target_")]


def wide_tiles(spark, sf, rows, features):
    """Tiles of the training rows of every farm together."""
    train = rows.where("split = 'train'").withColumn("all_", F.lit("all"))
    return L.tile_sums(train, features, TARGETS, ("all_",))


def wide_scores(spark, sf, rows):
    """Scores of all features of the wide frame, for the choice of features."""
    sums = value(spark, sf, "wide_sums", lambda: wide_tiles(spark, sf, rows, wide_features(rows)))
    return L.feature_scores(sums).drop("all_")


@query("e13_scores_of_all_places")
def e13_wide(spark, sf):
    """Scores of the features of all places for every horizon."""
    return wide_scores(spark, sf, wide_frame(spark, sf, train=True))


@query("e13_scores_of_places_facts", """
WITH t AS (SELECT *, (CAST(substr(turbine_id, 3) AS BIGINT) - 1) // 12 AS farm_no,
    'TB' || lpad(CAST((CAST(substr(turbine_id, 3) AS BIGINT) - 1) % 12 + 1 AS VARCHAR), 2, '0') AS place FROM t_clean),
held AS (SELECT place FROM t GROUP BY place HAVING count(DISTINCT farm_no) = (SELECT count(DISTINCT farm_no) FROM t)),
own AS (SELECT t.* FROM t SEMI JOIN held ON held.place = t.place),
total AS (SELECT farm_no, ts, sum(power) AS p FROM own GROUP BY farm_no, ts),
y AS (SELECT a.farm_no, a.ts, h.horizon, b.p AS y FROM total a CROSS JOIN t_horizon h JOIN total b ON b.farm_no = a.farm_no AND b.ts = a.ts + h.steps * INTERVAL '10 minutes'),
full_ AS (SELECT farm_no, ts FROM own GROUP BY farm_no, ts HAVING bool_and(power IS NOT NULL)),
r AS (SELECT own.place, y.horizon, own.power, y.y FROM own JOIN y ON y.farm_no = own.farm_no AND y.ts = own.ts SEMI JOIN full_ ON full_.farm_no = own.farm_no AND full_.ts = own.ts
  JOIN (SELECT DISTINCT ts FROM t_split WHERE split = 'train') s ON s.ts = own.ts WHERE y.y IS NOT NULL)
SELECT horizon, place || '_power' AS feature, count(*) AS n, round(corr(power, y), 6) AS r FROM r GROUP BY ALL""")
def e13_places(spark, sf):
    """Correlation of the power of each place with the farm's later power."""
    own = [f"{p}_power" for p in places(spark, sf)]
    scores = L.feature_scores(wide_tiles(spark, sf, wide_frame(spark, sf, train=True), own))
    return scores.select("horizon", "feature", "n", F.round("r", 6).alias("r"))


def best_wide(spark, sf, rows):
    """Names of the best features by horizon; the names, not the data, come to the driver."""
    def build():
        scores = wide_scores(spark, sf, rows)
        ranked = scores.groupBy("horizon").agg(F.slice(F.sort_array(F.collect_list(F.struct(
            F.coalesce(-F.col("f_score"), F.lit(float("inf"))).alias("s"), "feature"))), 1, DERIVED.top_features).alias("b"))
        return {r.horizon: [b.feature for b in r.b] for r in ranked.collect()}

    return value(spark, sf, "best_wide", build)


@query("g14_fair_experiment")
def g14_four(spark, sf):
    """Persistence, ridge and both boosted learners on all features of all places and on the best ones, every horizon, on the same complete rows."""
    def build():
        rows = wide_rows(spark, sf)
        every, best = wide_features(rows), best_wide(spark, sf, rows)
        asks = [L.Ask("all", every), L.Ask(f"top_{DERIVED.top_features}", best)]
        linear = L.compare(rows, asks, every, TARGETS).select("series_id", "horizon", "feature_set", F.lit("ridge").alias("model"), "mae", "rmse", "r2", "n_samples")
        held = L.long_labels(rows.dropna(subset=every).where("split = 'test'"), ["series_id", F.col("power").alias("y_pred")], TARGETS)
        still = L.squared_scores(held, ["series_id", "horizon"]).select(
            "series_id", "horizon", F.explode(F.array(*[F.lit(a.name) for a in asks])).alias("feature_set"), F.lit("persistence").alias("model"), "mae", "rmse", "r2", "n_samples")
        edges = X.bin_edges(rows.where("split = 'train'"), every)
        # rows with a missing feature are left out of training by the blocks and of the test here
        blocks = X.blocks(rows.where("split = 'train'").unionByName(rows.where("split = 'test'").dropna(subset=every)), every, edges, list(TARGETS.values()), "time_index")
        train, later = ends(spark, sf)
        chains = [X.Chain(f"{m}/{a.name}", h, i, X.LEARNERS[m], train, slots(spark, sf), 0, DERIVED.seed,
                          tuple(every.index(f) for f in (a.features[h] if isinstance(a.features, dict) else a.features)))
                  for m in ("gbt_a", "gbt_b") for a in asks for i, h in enumerate(HORIZONS)]
        scored = X.score(blocks, X.fit(blocks, chains), [replace(c, train_end=later) for c in chains]).where("y_true IS NOT NULL")
        name = F.split("model", "/")
        trees = L.squared_scores(scored.select("series_id", "horizon", name[1].alias("feature_set"), name[0].alias("m"), "y_true", "y_pred"),
                                 ["series_id", "horizon", "feature_set", "m"]).withColumnRenamed("m", "model")
        return linear.unionByName(still).unionByName(trees)

    return stage(spark, sf, "fair_experiment", build)


# The cases of the weather ablation by place in the list of turbines, and their leads.
WEATHER_CASES = ((2, "6hour"), (2, "24hour"), (1, "24hour"), (0, "6hour"), (0, "24hour"))
WEATHER_FIELDS = ("wind_speed", "wind_direction", "temperature")


def weather_cases(spark, sf, features):
    """Ridge with and without the weather valid at the target, all leads beside the full list in one pass."""
    leads = {h: HORIZONS[h] * DERIVED.interval_minutes for h in ("6hour", "24hour")}
    weather = weather_rows(spark, sf)
    rows = series_rows(spark, sf)
    named = {h: [f"nwp_{f}_{lead}" for f in WEATHER_FIELDS] for h, lead in leads.items()}
    chosen = weather.where(F.col("lead_minutes").isin(*leads.values())).groupBy("timestamp").agg(*[
        F.min(F.when(F.col("lead_minutes") == lead, F.struct(*WEATHER_FIELDS))).alias(f"_{lead}") for lead in leads.values()])
    beside = chosen.select(F.col("timestamp").alias("ts"), *[F.col(f"_{lead}")[f].alias(f"nwp_{f}_{lead}") for lead in leads.values() for f in WEATHER_FIELDS])
    joined = rows.join(beside, "ts", "left")
    asks = [L.Ask("scada_only", features), L.Ask("scada_plus_nwp", {h: [*features, *names] for h, names in named.items()})]
    every = [*features, *[f for names in named.values() for f in names]]
    return L.compare(joined, asks, every, {h: TARGETS[h] for h in leads}, needs=named)


@query("g16_weather_full")
def g16_full(spark, sf):
    """The five cases on the full feature list."""
    def build():
        scores = weather_cases(spark, sf, feature_names(spark, sf))
        number = F.when(F.col("series_id") == FARM_SERIES, 0).otherwise(F.regexp_extract("series_id", r"(\d+)$", 1).cast("int"))
        wanted = F.array(*[F.struct(F.lit(n), F.lit(h)) for n, h in WEATHER_CASES])
        kept = F.exists(wanted, lambda w: (w["col1"] == number) & (w["col2"] == F.col("horizon")))
        return scores.where(kept).withColumn("nmae_pct", F.col("mae") / G.rated_power(F.col("series_id"), farm_settings(spark, sf)) * 100)

    return stage(spark, sf, "weather_full", build)


cte("t_nwp", """
SELECT t.*, CASE horizon WHEN '6hour' THEN w36 ELSE w144 END AS nwp FROM t_target t
JOIN (SELECT ts, lead(farm_avg_wind, 36) OVER (ORDER BY ts) AS w36, lead(farm_avg_wind, 144) OVER (ORDER BY ts) AS w144 FROM t_farm) f
  ON f.ts = t.ts
WHERE horizon IN ('6hour', '24hour') AND power IS NOT NULL AND y_true IS NOT NULL
  AND CASE horizon WHEN '6hour' THEN w36 ELSE w144 END IS NOT NULL
""")
cte("t_ablation", """
SELECT r.series_id, r.horizon, feature_set, avg(abs(p - y_true)) AS mae, sqrt(avg((p - y_true) ** 2)) AS rmse,
  1 - sum((p - y_true) ** 2) / (var_pop(y_true) * count(*)) AS r2, count(*) AS n_samples
FROM (SELECT t.series_id, t.horizon, y_true, feature_set, CASE feature_set
      WHEN 'scada_only' THEN ym + n * cpy / ps / (n + 1.0::DOUBLE) / ps * (power - pm)
      ELSE ym + (b1 * d - b2 * c12) / (d * d - c12 * c12) / ps * (power - pm) + (b2 * d - b1 * c12) / (d * d - c12 * c12) / ws * (nwp - wm)
    END AS p
  FROM t_nwp t JOIN (SELECT *, 1 + 1.0::DOUBLE / n AS d, cpw / ps / ws AS c12, cpy / ps AS b1, cwy / ws AS b2 FROM (
      SELECT series_id, horizon, count(*) AS n, avg(power) AS pm, avg(nwp) AS wm, avg(y_true) AS ym, stddev_pop(power) AS ps,
        stddev_pop(nwp) AS ws, covar_pop(power, nwp) AS cpw, covar_pop(power, y_true) AS cpy, covar_pop(nwp, y_true) AS cwy
      FROM t_nwp WHERE split = 'train' GROUP BY ALL)) f ON f.series_id = t.series_id AND f.horizon = t.horizon
  CROSS JOIN (VALUES ('scada_only'), ('scada_plus_nwp')) v(feature_set) WHERE split = 'test') r
GROUP BY ALL
""")


def weather_ablation(spark, sf):
    rows = series_targets(spark, sf)
    weather = weather_rows(spark, sf)
    both = None
    for horizon, lead in (("6hour", 360), ("24hour", 1440)):
        part = E.add_weather(rows.where(F.col("horizon") == horizon), weather, lead)
        both = part if both is None else both.unionByName(part)
    blocks = {"scada_only": ["power"], "scada_plus_nwp": ["power", "nwp_wind_speed"]}
    return G.compare_linear(both, blocks, 1.0, farm_settings(spark, sf))


@query("g16_weather_ablation", """
SELECT series_id, horizon, feature_set, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, n_samples,
  round(mae / CASE WHEN series_id = 'farm_total_power' THEN farm_rated ELSE 2200.0::DOUBLE END * 100, 4) AS nmae_pct
FROM t_ablation, t_rated""")
def g16(spark, sf):
    return rounded(weather_ablation(spark, sf))


@query("i33_ablation_side_by_side", """
SELECT series_id, horizon, round(max(rmse) FILTER (feature_set = 'scada_only'), 4) AS rmse_scada_only,
  round(max(r2) FILTER (feature_set = 'scada_only'), 4) AS r2_scada_only,
  round(max(rmse) FILTER (feature_set = 'scada_plus_nwp'), 4) AS rmse_scada_plus_nwp,
  round(max(r2) FILTER (feature_set = 'scada_plus_nwp'), 4) AS r2_scada_plus_nwp,
  round(max(rmse) FILTER (feature_set = 'scada_plus_nwp') - max(rmse) FILTER (feature_set = 'scada_only'), 4) AS rmse_change
FROM t_ablation GROUP BY series_id, horizon""")
def i33(spark, sf):
    return rounded(B.ablation_side_by_side(weather_ablation(spark, sf), ("scada_only", "scada_plus_nwp")))
