"""Registered queries of the tree learners on all series and horizons, and of serving stored models."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.operators import boosting as X
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.operators import forecasts as H
from gustline.operators import models as G
from gustline.operators import scoring as I
from gustline.operators import serving as V
from gustline.operators import splits as S
from gustline.plans.q_clean import clean_frame, farm_settings
from gustline.plans.q_features import bounds, series_targets
from gustline.plans.q_scores import LEARNED, rounded, test_predictions
from gustline.plans.registry import query
from gustline.plans.sqlbase import cte
from gustline.plans.stages import stage, value
from gustline.settings import FARM_SERIES, HORIZONS
from gustline.sources.derived import DERIVED

# The grid searched for each boosted learner.
GRID_TREES, GRID_DEPTHS, GRID_RATES = (100, 150, 200), (4, 6), (0.05, 0.1)
GRID_FEATURES = ["power", "wind_speed", "power_lag1", "power_lag6", "power_lag144", "power_roll6_mean",
                 "power_roll36_std", "power_diff1", "wind_speed_lag1", "wind_speed_roll6_mean", "hour_sin", "hour_cos"]
FOLDS = 3
LABELS = [f"power_target_{h}" for h in HORIZONS]

# Two trees of two levels on three features: small enough for SQL to grow them too, for every series, horizon and fold.
SMALL_FEATURES = ["power", "wind_speed", "power_roll6_mean"]
SMALL = {"small_a": X.Boost(2, 2, rate=0.5, columns=0.7, penalty=1.0, least=1),
         "small_b": X.Boost(2, 2, rate=0.5, columns=0.7, penalty=0.0, least=20, leaves=3)}


def series_rows(spark, sf):
    """Turbines and farm with features that look back and targets of all horizons, one row per slot."""
    return stage(spark, sf, "series_features", lambda: placed_features(spark, sf, C.series_frame(clean_frame(spark, sf), "all"), X.tasks_wanted(spark)))


def farm_series_rows(spark, sf):
    """The farm's rows of `series_rows`, worked out without those of the turbines."""
    series = C.series_frame(clean_frame(spark, sf), "all").where(F.col("series_id") == FARM_SERIES)
    return stage(spark, sf, "farm_series_features", lambda: placed_features(spark, sf, series))


def placed_features(spark, sf, series, tasks=None):
    rows = E.window_features(series, DERIVED, ["power", "wind_speed"], series="series_id", tasks=tasks).withColumns(E.calendar_columns())
    return S.split_by_time(S.add_time_index(rows, bounds(spark, sf), DERIVED), bounds(spark, sf), DERIVED)


def feature_names(spark, sf):
    return [f for f in E.select_feature_columns(series_rows(spark, sf)) if f not in LABELS]


def slots(spark, sf):
    """Number of grid slots of the input."""
    low, high = bounds(spark, sf)
    return value(spark, sf, "n_slots", lambda: spark.range(1).select((high - low + 1).alias("n")).first().n)


def ends(spark, sf):
    """Positions where training and validation end."""
    n = slots(spark, sf)
    return int(n * DERIVED.train_ratio), int(n * (DERIVED.train_ratio + DERIVED.val_ratio))


def fold_bounds(spark, sf):
    """(fold, train end, validation end) of the walk-forward folds that are large enough."""
    def build():
        rows = spark.range(1).select(F.lit(slots(spark, sf)).alias("n")).select(F.explode(F.array(*[S.fold_ends(F.col("n"), i + 1) for i in range(FOLDS)])).alias("f"))
        usable = [r.f for r in rows.collect()]
        return [(f.fold, f.train_end, f.validation_end) for f in usable if f.test_end <= f.n and f.train_end >= S.MIN_TRAIN
                and f.validation_end - f.train_end >= S.MIN_VAL and f.test_end - f.validation_end >= S.MIN_TEST]

    return value(spark, sf, "fold_bounds", build)


def binned(spark, sf, name, features, rows=None):
    """Edges from the training rows, and blocks of all rows, of one feature list."""
    def build():
        whole = series_rows(spark, sf) if rows is None else rows
        edges = X.bin_edges(whole.where("split = 'train'"), features)
        return edges, X.blocks(whole, features, edges, LABELS, "time_index")

    return value(spark, sf, f"blocks_{name}", build)


def chains_of(learners, train_end, test_end, fold=0):
    return [X.Chain(m, h, i, p, train_end, test_end, fold, DERIVED.seed) for m, p in learners.items() for i, h in enumerate(HORIZONS)]


def learned(spark, sf, wanted=tuple(X.LEARNERS)):
    """Models of the wanted learners for every series and horizon: (chains, stored models, features, edges, blocks).

    Learners that no query has asked for are not grown; those asked for together are grown together. The chains are those of all learners.
    """
    features = feature_names(spark, sf)
    edges, blocks = binned(spark, sf, "all", features)
    chains, known = chains_of(X.LEARNERS, *ends(spark, sf)), value(spark, sf, "learned", dict)
    new = [i for i, c in enumerate(chains) if c.model in wanted and c.model not in known]
    if new:
        own = X.fit(blocks, [chains[i] for i in new]).withColumn("chain", F.array(*[F.lit(i) for i in new])[F.col("chain")])
        known.update({chains[i].model: own for i in new})
    fits = {id(known[m]): known[m] for m in wanted}
    parts = [fit.where(F.col("chain").isin([i for i, c in enumerate(chains) if c.model in wanted and known[c.model] is fit])) for fit in fits.values()]
    return chains, reduce(DataFrame.unionByName, parts), features, edges, blocks


def cell_scores(scored, keys=("series_id", "horizon", "model")):
    e = F.col("y_pred") - F.col("y_true")
    return scored.where("y_true IS NOT NULL").groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.coalesce(1 - F.try_divide(F.sum(e * e), F.var_pop("y_true") * F.count("*")), F.lit(0.0)).alias("r2"), F.count("*").alias("n_samples"))


def best_of_learners(scores):
    """The scores with the learner of least RMSE of every target marked; names break ties."""
    best = scores.groupBy("series_id", "horizon").agg(F.min_by("model", F.struct("rmse", "model")).alias("_best"))
    return scores.join(best, ["series_id", "horizon"]).withColumn("is_best", F.col("model") == F.col("_best")).drop("_best")


def validated(spark, sf):
    """Validation scores of every series, horizon and learner."""
    def build():
        chains, models, _, _, blocks = learned(spark, sf)
        return best_of_learners(cell_scores(X.score(blocks, models, chains)))

    return stage(spark, sf, "train_all", build)


# ---- the small models that SQL can follow

def small_chains(spark, sf):
    train, validation = ends(spark, sf)
    out = chains_of(SMALL, train, validation)
    for fold, train_end, test_end in fold_bounds(spark, sf):
        out += chains_of(SMALL, train_end, test_end, fold)
    return out


def small(spark, sf):
    def build():
        edges, blocks = binned(spark, sf, "small", SMALL_FEATURES)
        chains = small_chains(spark, sf)
        return chains, X.fit(blocks, chains), SMALL_FEATURES, edges, blocks

    return value(spark, sf, "small_models", build)


def small_predictions(spark, sf):
    """Forecasts of the small models of the main split for the test rows, in the shape of the long prediction table."""
    def build():
        chains, models, _, _, blocks = small(spark, sf)
        main = [i for i, c in enumerate(chains) if not c.fold]
        later = [replace(c, train_end=c.test_end, test_end=slots(spark, sf)) for c in chains]
        return long_rows(spark, sf, X.score(blocks, models.where(F.col("chain").isin(main)), later).drop("fold", "y_true"))

    return stage(spark, sf, "small_predictions", build)


def long_rows(spark, sf, scored):
    """Forecasts of test rows by (series_id, horizon, model, pos) as rows of the long prediction table."""
    rows = S.add_time_index(series_targets(spark, sf).where("split = 'test'"), bounds(spark, sf), DERIVED).withColumnRenamed("time_index", "pos")
    rated = G.rated_power(F.col("series_id"), farm_settings(spark, sf)).alias("rated")
    return rows.join(scored, ["series_id", "horizon", "pos"]).select(*series_targets(spark, sf).columns, rated, "model", "y_pred")


cte("b_rows", """
SELECT series_id, CASE WHEN series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END AS level, pos, split, unnest([0, 1, 2]) AS f,
  unnest([power, wind_speed, roll6]) AS v FROM t_target WHERE horizon = '10min'
""")
cte("b_ends", """
SELECT level, f, lo, n, CASE WHEN hi > lo THEN (hi - lo) / 4096 ELSE 1.0::DOUBLE END AS step
FROM (SELECT level, f, min(v) AS lo, max(v) AS hi, count(v) AS n FROM b_rows WHERE split = 'train' AND v IS NOT NULL GROUP BY level, f)
""")
cte("b_first", """
SELECT *, CAST(sum(c) OVER (PARTITION BY level, f ORDER BY b) AS BIGINT) AS upto FROM (
  SELECT r.level, r.f, any_value(n) AS n, any_value(lo) AS lo, any_value(step) AS step,
    CAST(least(floor((v - lo) / step), 4095) AS BIGINT) AS b, count(*) AS c
  FROM b_rows r JOIN b_ends e ON e.level = r.level AND e.f = r.f WHERE split = 'train' AND v IS NOT NULL GROUP BY r.level, r.f, b)
""")
cte("b_wanted", """
SELECT level, f, k, any_value(n) * k AS rank, any_value(lo) AS lo, any_value(step) AS step, min(b) AS b, arg_min(upto - c, b) AS before
FROM b_first, (SELECT unnest(range(1, 64)) AS k) WHERE upto * 64 >= n * k GROUP BY level, f, k
""")
cte("b_second", """
SELECT *, CAST(sum(c) OVER (PARTITION BY level, f, b ORDER BY part) AS BIGINT) AS upto FROM (
  SELECT w.level, w.f, w.b, CAST(greatest(least(floor((v - (lo + w.b * step)) / (step / 256)), 255), 0) AS BIGINT) AS part, count(*) AS c
  FROM (SELECT DISTINCT level, f, b, lo, step FROM b_wanted) w JOIN b_rows r ON r.level = w.level AND r.f = w.f
  WHERE split = 'train' AND v IS NOT NULL AND CAST(least(floor((v - lo) / step), 4095) AS BIGINT) = w.b GROUP BY w.level, w.f, w.b, part)
""")
cte("b_edges", """
SELECT level, f, list(edge ORDER BY k) AS edges FROM (
  SELECT w.level, w.f, k, any_value(lo) + any_value(w.b) * any_value(step) + (min(part) + 1) * (any_value(step) / 256) AS edge
  FROM b_wanted w JOIN b_second s ON s.level = w.level AND s.f = w.f AND s.b = w.b WHERE (before + upto) * 64 >= rank GROUP BY w.level, w.f, k)
GROUP BY level, f
""")
cte("b_codes", """
SELECT series_id, pos, list(code ORDER BY f) AS codes, bool_and(v IS NOT NULL) AS whole FROM (
  SELECT series_id, pos, r.f, v, len(list_filter(edges, lambda e: e < coalesce(v, 0.0::DOUBLE))) AS code
  FROM b_rows r JOIN b_edges e ON e.level = r.level AND e.f = r.f) GROUP BY series_id, pos
""")
cte("b_fold", f"""
SELECT 0 AS fold, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS train_end, CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) AS test_end FROM t_bounds
UNION ALL SELECT fold, CAST(greatest(floor(n * (0.25::DOUBLE + (fold - 1) * 0.12::DOUBLE)), 100) AS BIGINT),
  CAST(floor(n * (0.25::DOUBLE + fold * 0.12::DOUBLE)) AS BIGINT) FROM t_bounds, (SELECT CAST(unnest(range(1, {FOLDS + 1})) AS INTEGER) AS fold)
""")


def grow_ctes(prefix, learners, folds):
    """Common table expressions that grow the trees of small learners: `<prefix>_tree<t>` holds nodes, `<prefix>_guess<t>` forecasts after t trees."""
    listed = ", ".join(f"('{m}', {p.penalty}::DOUBLE, {p.least}, {p.rate}::DOUBLE)" for m, p in learners.items())
    first = next(iter(learners.values()))
    cte(f"{prefix}_guess0", f"""
SELECT model, penalty, least, rate, fold, r.*, sum(CASE WHEN used THEN units END) OVER w::DOUBLE / (count(CASE WHEN used THEN 1 END) OVER w * 65536)::DOUBLE AS guess
FROM (SELECT c.fold, c.train_end, c.test_end, t.series_id, t.horizon, t.pos, y_true, codes, whole AND y_true IS NOT NULL AND t.pos < train_end AS used,
    CAST(floor(y_true * 65536 + 0.5) AS BIGINT) AS units
  FROM t_target t JOIN b_codes b ON b.series_id = t.series_id AND b.pos = t.pos CROSS JOIN b_fold c WHERE {folds}) r
CROSS JOIN (VALUES {listed}) m(model, penalty, least, rate) WINDOW w AS (PARTITION BY model, fold, series_id, horizon)""")
    for t in range(first.trees):
        picked = X.drawn_features(len(SMALL_FEATURES), t, first, DERIVED.seed).tolist()
        keys = "model, fold, series_id, horizon"
        cte(f"{prefix}_at{t}_0", f"""
SELECT * EXCLUDE (units), CAST(floor((y_true - guess) * 65536 + 0.5) AS BIGINT) AS units, 1 AS node,
  used AND {X.draw_sql('pos', t, DERIVED.seed)} % 1000 < {round(first.rows * 1000)} AS inside FROM {prefix}_guess{t}""")
        for level in range(first.depth):
            cte(f"{prefix}_sums{t}_{level}", f"""
SELECT *, CAST(sum(u) OVER (PARTITION BY {keys}, node, f ORDER BY code) AS BIGINT) AS ul, CAST(sum(c) OVER (PARTITION BY {keys}, node, f ORDER BY code) AS BIGINT) AS nl,
  CAST(sum(u) OVER (PARTITION BY {keys}, node, f) AS BIGINT) AS ut, CAST(sum(c) OVER (PARTITION BY {keys}, node, f) AS BIGINT) AS nt
FROM (SELECT {keys}, node, f, codes[f + 1] AS code, any_value(penalty) AS penalty, any_value(least) AS least, sum(units) AS u, count(*) AS c
  FROM {prefix}_at{t}_{level}, (SELECT unnest({picked}) AS f) WHERE inside AND node >= {1 << level} GROUP BY {keys}, node, f, code)""")
            cte(f"{prefix}_best{t}_{level}", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, node ORDER BY gain DESC, f, code) AS rn FROM (
  SELECT {keys}, node, f, code, nt, (ul / 65536.0::DOUBLE) * (ul / 65536.0::DOUBLE) / (nl + penalty)
    + ((ut - ul) / 65536.0::DOUBLE) * ((ut - ul) / 65536.0::DOUBLE) / (nt - nl + penalty) - (ut / 65536.0::DOUBLE) * (ut / 65536.0::DOUBLE) / (nt + penalty) AS gain
  FROM {prefix}_sums{t}_{level} WHERE nl >= least AND nt - nl >= least AND code < 63)) WHERE rn = 1 AND gain > 0""")
            cte(f"{prefix}_at{t}_{level + 1}", f"""
SELECT a.* REPLACE (CASE WHEN b.f IS NULL THEN a.node ELSE 2 * a.node + CAST(codes[b.f + 1] > b.code AS INTEGER) END AS node)
FROM {prefix}_at{t}_{level} a LEFT JOIN {prefix}_best{t}_{level} b ON b.model = a.model AND b.fold = a.fold AND b.series_id = a.series_id
  AND b.horizon = a.horizon AND b.node = a.node""")
        if first.depth != 2:
            continue
        # the leaf-wise learner has room for one more split than the root: that of the child which gains more
        cte(f"{prefix}_cut{t}", f"""
SELECT {keys}, node FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, node) AS place FROM {prefix}_best{t}_1)
WHERE place > 1 AND model = 'small_b'""")
        cte(f"{prefix}_leaf{t}", f"""
SELECT a.* REPLACE (coalesce(c.node, a.node) AS node) FROM {prefix}_at{t}_2 a LEFT JOIN {prefix}_cut{t} c
  ON c.model = a.model AND c.fold = a.fold AND c.series_id = a.series_id AND c.horizon = a.horizon AND c.node = a.node // 2""")
        cte(f"{prefix}_value{t}", f"""
SELECT {keys}, node, count(*) AS n, any_value(rate) * (sum(units)::BIGINT / 65536.0::DOUBLE) / (count(*) + any_value(penalty)) AS value
FROM {prefix}_leaf{t} WHERE inside GROUP BY {keys}, node""")
        cte(f"{prefix}_guess{t + 1}", f"""
SELECT l.* EXCLUDE (node, inside, units, guess), CAST(floor(y_true * 65536 + 0.5) AS BIGINT) AS units, guess + coalesce(value, 0.0::DOUBLE) AS guess
FROM {prefix}_leaf{t} l LEFT JOIN {prefix}_value{t} v ON v.model = l.model AND v.fold = l.fold AND v.series_id = l.series_id
  AND v.horizon = l.horizon AND v.node = l.node""")


grow_ctes("b_main", SMALL, "c.fold = 0")
grow_ctes("b_walk", SMALL, "c.fold > 0")
cte("b_pred", """
SELECT t.*, g.model, guess AS y_pred, CASE WHEN t.series_id = 'farm_total_power' THEN farm_rated ELSE 2200.0::DOUBLE END AS rated
FROM b_main_guess2 g JOIN t_target t ON t.series_id = g.series_id AND t.horizon = g.horizon AND t.pos = g.pos CROSS JOIN t_rated WHERE guess IS NOT NULL
""")
cte("b_scores", """
SELECT series_id, horizon, model, fold, avg(abs(guess - y_true)) AS mae, sqrt(avg((guess - y_true) ** 2)) AS rmse,
  coalesce(1 - sum((guess - y_true) ** 2) / nullif(var_pop(y_true) * count(*), 0), 0) AS r2, count(*) AS n_samples
FROM (SELECT * FROM b_main_guess2 UNION ALL SELECT * FROM b_walk_guess2) WHERE y_true IS NOT NULL AND guess IS NOT NULL AND pos >= train_end AND pos < test_end
GROUP BY ALL
""")
cte("b_test", """
SELECT series_id, horizon, model, y_pred, y_true, rated FROM t_test UNION ALL
SELECT series_id, horizon, model, y_pred, y_true, rated FROM b_pred WHERE split = 'test' AND is_observed = 1 AND is_imputed = 0 AND is_simulated = 0 AND y_true IS NOT NULL
""")
cte("b_means", """
SELECT CASE WHEN series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END AS level, horizon, model, avg(rmse) AS rmse
FROM (SELECT series_id, horizon, model, sqrt(avg((y_pred - y_true) ** 2)) AS rmse FROM b_test GROUP BY ALL) GROUP BY ALL
""")
cte("b_champion", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, horizon ORDER BY rmse, model) AS rn FROM b_means
  WHERE model IN ('linear_wind', 'linear_roll', 'small_a', 'small_b')) WHERE rn = 1
""")

# Three levels of the first tree, for the learners' own penalties and leaf sizes.
FIRST_TREE = {"gbt_a": replace(X.LEARNERS["gbt_a"], trees=1, depth=3, columns=0.7), "gbt_b": replace(X.LEARNERS["gbt_b"], trees=1, depth=3, columns=0.7, leaves=4)}
grow_ctes("b_one", FIRST_TREE, "c.fold = 0")


def first_trees(spark, sf):
    """Nodes of the first tree of every series and horizon on three features, depth-wise and leaf by leaf."""
    def build():
        edges, blocks = binned(spark, sf, "small", SMALL_FEATURES)
        chains = chains_of(FIRST_TREE, *ends(spark, sf))
        return X.nodes(X.fit(blocks, chains), chains, SMALL_FEATURES).drop("fold", "tree")

    return stage(spark, sf, "first_trees", build)


SPLITS = "['power', 'wind_speed', 'power_roll6_mean'][f + 1] AS feature, CAST(code AS INTEGER) AS bin, round(gain / nt, 4) AS gain_per_row, nt AS n"


def splits_of(nodes):
    return nodes.where("feature IS NOT NULL").select("series_id", "horizon", "node", "feature", "bin", F.round(F.col("gain") / F.col("n"), 4).alias("gain_per_row"), "n")


# ---- learners and their scores

def tested(spark, sf, model):
    """Test scores of one learner for every series and horizon."""
    def build():
        chains, models, _, _, blocks = learned(spark, sf, (model,))
        later = [replace(c, train_end=c.test_end, test_end=slots(spark, sf)) for c in chains]
        return cell_scores(X.score(blocks, models, later)).drop("model")

    return stage(spark, sf, f"tested_{model}", build)


@query("g4_forests_of_all")
def g4_all(spark, sf):
    return tested(spark, sf, "random_forest")


@query("g5_boosting_a")
def g5(spark, sf):
    return tested(spark, sf, "gbt_a")


@query("g5_boosting_a_facts", f"""
SELECT series_id, horizon, CAST(node AS INTEGER) AS node, {SPLITS}
FROM (SELECT * FROM b_one_best0_0 UNION ALL SELECT * FROM b_one_best0_1 UNION ALL SELECT * FROM b_one_best0_2) WHERE model = 'gbt_a'""")
def g5_facts(spark, sf):
    """Splits of the first tree of every series and horizon, three levels."""
    return splits_of(first_trees(spark, sf).where("model = 'gbt_a'"))


@query("g6_boosting_b")
def g6(spark, sf):
    return tested(spark, sf, "gbt_b")


@query("g6_boosting_b_facts", f"""
WITH s AS (SELECT * FROM b_one_best0_0 UNION ALL SELECT * FROM b_one_best0_1 UNION ALL SELECT * FROM b_one_best0_2),
two AS (SELECT series_id, horizon, arg_min(node, (-gain, node)) AS node FROM s WHERE model = 'gbt_b' AND node IN (2, 3) GROUP BY ALL),
three AS (SELECT s.series_id, s.horizon, arg_min(s.node, (-gain, s.node)) AS node FROM s JOIN two ON two.series_id = s.series_id AND two.horizon = s.horizon
  WHERE model = 'gbt_b' AND (s.node // 2 = two.node OR s.node = 5 - two.node) GROUP BY ALL)
SELECT series_id, horizon, CAST(node AS INTEGER) AS node, {SPLITS} FROM s WHERE model = 'gbt_b' AND (node = 1
  OR (series_id, horizon, node) IN (SELECT (series_id, horizon, node) FROM two) OR (series_id, horizon, node) IN (SELECT (series_id, horizon, node) FROM three))""")
def g6_facts(spark, sf):
    """The first three splits by best gain of the first tree of every series and horizon."""
    return splits_of(first_trees(spark, sf).where("model = 'gbt_b'"))


@query("g7_train_all")
def g7(spark, sf):
    return validated(spark, sf)


@query("g7_train_all_facts", """
SELECT series_id, horizon, model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, n_samples,
  row_number() OVER (PARTITION BY series_id, horizon ORDER BY round(rmse, 6), model) = 1 AS is_best
FROM b_scores WHERE fold = 0""")
def g7_facts(spark, sf):
    """Validation scores of the small learners for every series and horizon, the best marked."""
    chains, models, _, _, blocks = small(spark, sf)
    scores = cell_scores(X.score(blocks, models, chains), ("series_id", "horizon", "model", "fold")).where("fold = 0").drop("fold")
    return rounded(best_of_learners(scores.withColumn("rmse", F.round("rmse", 6))))


# ---- grid search and walk-forward

def grid_chains(spark, sf):
    """One chain of the most trees for each learner, depth, rate and fold; fewer trees are a shorter walk along it."""
    n = ends(spark, sf)[1]
    low, high = bounds(spark, sf)
    block = n // (FOLDS + 1)
    out = []
    for learner in ("gbt_a", "gbt_b"):
        for depth in GRID_DEPTHS:
            for rate in GRID_RATES:
                preset = replace(X.LEARNERS[learner], trees=max(GRID_TREES), depth=depth, rate=rate, rows=1.0, columns=1.0)
                for i in range(FOLDS):
                    out.append(X.Chain(f"{learner}/{depth}/{rate}", "1hour", list(HORIZONS).index("1hour"), preset,
                                       n - block * (FOLDS - i), n - block * (FOLDS - i - 1), i + 1, DERIVED.seed))
    return out


def farm_blocks(spark, sf):
    return binned(spark, sf, "grid", GRID_FEATURES, farm_series_rows(spark, sf))[1]


def grid_records(spark, sf):
    """RMSE and rows by learner, trees, depth, rate and fold."""
    def build():
        blocks, chains = farm_blocks(spark, sf), grid_chains(spark, sf)
        scored = X.score(blocks, X.fit(blocks, chains), chains, "test", GRID_TREES).where("y_true IS NOT NULL")
        e = F.col("y_pred") - F.col("y_true")
        parts = F.split("model", "/")
        return scored.groupBy(parts[0].alias("model"), "trees", parts[1].cast("int").alias("depth"), parts[2].cast("double").alias("step"), "fold").agg(
            F.sqrt(F.avg(e * e)).alias("rmse"), F.count("*").alias("n_samples"))

    return stage(spark, sf, "grid_records", build)


@query("g8_grid_search")
def g8(spark, sf):
    """Mean RMSE of the folds by learner and preset; the best of each learner fitted on training and validation rows and scored on the test rows."""
    def build():
        means = grid_records(spark, sf).groupBy("model", "trees", "depth", "step").agg(F.avg("rmse").alias("mean_rmse"), F.count("*").alias("n_folds"))
        best = [r.b for r in means.groupBy("model").agg(F.min_by(F.struct("model", "trees", "depth", "step"), F.struct("mean_rmse", "trees", "depth", "step")).alias("b")).collect()]
        chains = [X.Chain(b.model, "1hour", list(HORIZONS).index("1hour"),
                          replace(X.LEARNERS[b.model], trees=b.trees, depth=b.depth, rate=b.step, rows=1.0, columns=1.0),
                          ends(spark, sf)[1], slots(spark, sf), 0, DERIVED.seed) for b in best]
        blocks = farm_blocks(spark, sf)
        again = cell_scores(X.score(blocks, X.fit(blocks, chains), chains)).select("model", F.col("rmse").alias("_rmse"))
        is_best = F.lit(False)
        for b in best:
            is_best = is_best | ((F.col("model") == b.model) & (F.col("trees") == b.trees) & (F.col("depth") == b.depth) & (F.col("step") == b.step))
        marked = means.withColumn("is_best", is_best)
        return marked.join(again, "model", "left").withColumn("test_rmse", F.when(F.col("is_best"), F.col("_rmse"))).drop("_rmse")

    return stage(spark, sf, "grid_search", build)


@query("g8_grid_facts", f"""
SELECT model, trees, depth, step, CAST(fold AS INTEGER) AS fold, count(*) AS n_samples
FROM (SELECT pos, fold, q, q // 4 AS block FROM t_target, (SELECT CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) AS q FROM t_bounds),
    (SELECT unnest(range(1, {FOLDS + 1})) AS fold) WHERE series_id = 'farm_total_power' AND horizon = '1hour' AND y_true IS NOT NULL)
CROSS JOIN (SELECT unnest({list(GRID_TREES)}) AS trees) CROSS JOIN (SELECT unnest({list(GRID_DEPTHS)}) AS depth)
CROSS JOIN (SELECT unnest({list(GRID_RATES)})::DOUBLE AS step) CROSS JOIN (VALUES ('gbt_a'), ('gbt_b')) m(model)
WHERE pos >= q - block * ({FOLDS} - fold + 1) AND pos < q - block * ({FOLDS} - fold) GROUP BY ALL""")
def g8_facts(spark, sf):
    """Rows scored by learner, preset and fold."""
    return grid_records(spark, sf).select("model", "trees", "depth", "step", "fold", "n_samples")


@query("g10_walk_forward_trees")
def g10(spark, sf):
    """Scores of the boosted learners on every fold of every series and horizon."""
    def build():
        blocks = binned(spark, sf, "all", feature_names(spark, sf))[1]
        boosted = {m: p for m, p in X.LEARNERS.items() if not p.average}
        chains = [c for fold, train_end, test_end in fold_bounds(spark, sf) for c in chains_of(boosted, train_end, test_end, fold)]
        return cell_scores(X.score(blocks, X.fit(blocks, chains), chains), ("series_id", "horizon", "model", "fold"))

    return stage(spark, sf, "walk_forward_trees", build)


@query("g10_walk_forward_facts", """
SELECT series_id, horizon, model, fold, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, n_samples FROM b_scores WHERE fold > 0""")
def g10_facts(spark, sf):
    """Scores of the small learners on every fold of every series and horizon."""
    chains, models, _, _, blocks = small(spark, sf)
    return rounded(cell_scores(X.score(blocks, models, chains), ("series_id", "horizon", "model", "fold")).where("fold > 0"))


# ---- forecasts of stored models

def tree_predictions(spark, sf):
    """Forecasts of the three learners for the test rows of all series and horizons, in the shape of the long prediction table."""
    def build():
        chains, models, _, _, blocks = learned(spark, sf)
        later = [replace(c, train_end=c.test_end, test_end=slots(spark, sf)) for c in chains]
        return long_rows(spark, sf, X.score(blocks, models, later).drop("fold", "y_true"))

    return stage(spark, sf, "tree_predictions", build)


@query("g12_batch_predict")
def g12(spark, sf):
    return tree_predictions(spark, sf).select("series_id", "ts", "horizon", "model", "y_pred", "y_true")


@query("g12_batch_facts", """
SELECT series_id, ts, horizon, model, round(y_pred, 4) AS y_pred, y_true FROM b_pred WHERE split = 'test'""")
def g12_facts(spark, sf):
    """Forecasts of the small stored models for the test rows."""
    return small_predictions(spark, sf).where("split = 'test'").select("series_id", "ts", "horizon", "model", F.round("y_pred", 4).alias("y_pred"), "y_true")


def all_official(spark, sf, trees):
    return I.official_rows(test_predictions(spark, sf).unionByName(trees))


@query("i1_metrics_of_trees")
def i1_trees(spark, sf):
    """Official metrics of the closed-form models and the three tree learners side by side."""
    return stage(spark, sf, "metrics_of_trees", lambda: I.metrics(all_official(spark, sf, tree_predictions(spark, sf))))


@query("h8_champions_with_trees")
def h8_trees(spark, sf):
    """The registry of champions among lines and tree learners."""
    return H.registry(i1_trees(spark, sf), [*LEARNED, *X.LEARNERS])


@query("h8_champions_with_small_trees", """
SELECT level, horizon, model, round(rmse, 4) AS rmse,
  CASE level WHEN 'farm' THEN 'farm_total_power' ELSE 'turbine_power' END || '_target_' || horizon || '_' || model AS model_key,
  'v5' AS feature_version, CAST(NULL AS TIMESTAMP) AS training_cutoff, 'PASS' AS quality_flag FROM b_champion""")
def h8_small(spark, sf):
    return rounded(H.registry(I.metrics(all_official(spark, sf, small_predictions(spark, sf))), [*LEARNED, *SMALL]))


@query("i9_gate_of_trees")
def i9_trees(spark, sf):
    """Test scores of the second boosted learner against those of the first, target by target."""
    return I.regression_gate(tested(spark, sf, "gbt_b"), tested(spark, sf, "gbt_a"))


@query("h9_champions_beside_trees")
def h9_trees(spark, sf):
    """The champion over all models, persistence included, with the best learned one beside it."""
    return H.champions_beside_best(i1_trees(spark, sf), [*LEARNED, *X.LEARNERS])


@query("h3_intervals_of_trees")
def h3_trees(spark, sf):
    """Symmetric intervals around the forecasts of the tree learners."""
    return H.symmetric_intervals(H.forecast_table(tree_predictions(spark, sf).where("is_simulated = 0")))


def linear_rows(spark, sf):
    """Stored coefficients of the linear models: (series_id, horizon, model, intercept, coefs over power, wind and rolling mean)."""
    def build():
        rows = series_rows(spark, sf)
        long = S.long_targets(rows.select("series_id", "split", *SMALL_FEATURES, *LABELS))
        train = E.training_frame(long.where("split = 'train'"), SMALL_FEATURES, "y_true")
        fits = train.groupBy(*G.TARGET_KEYS).agg(*G.fit_one_feature(train, "wind_speed", prefix="wind_"), *G.fit_one_feature(train, "power_roll6_mean", prefix="roll_"))
        zero = F.lit(0.0)
        models = F.array(
            F.struct(F.lit("linear_wind").alias("model"), F.col("wind_intercept").alias("intercept"), F.array(zero, "wind_slope", zero).alias("coefs")),
            F.struct(F.lit("linear_roll").alias("model"), F.col("roll_intercept").alias("intercept"), F.array(zero, zero, "roll_slope").alias("coefs")))
        return fits.select(*G.TARGET_KEYS, F.explode(models).alias("m")).select(*G.TARGET_KEYS, "m.*")

    return stage(spark, sf, "linear_rows", build)


def requests(spark, sf):
    """All test slots of all series and horizons, scored before or not, and a turbine that no model knows."""
    known = series_rows(spark, sf).where("split = 'test'").select("series_id", "ts")
    unknown = known.where(F.col("series_id") == FARM_SERIES).select(F.lit("TB99999").alias("series_id"), "ts")
    return known.unionByName(unknown).select("*", F.explode(F.array(*[F.lit(h) for h in HORIZONS])).alias("horizon"))


def serve(spark, sf, official, deployable, models):
    chains, stored, features, edges, _ = models
    main = [i for i, c in enumerate(chains) if not c.fold]
    store = V.TreeStore(stored.where(F.col("chain").isin(main)), [c if not c.fold else replace(c, model=f"{c.model}_fold{c.fold}") for c in chains], features, edges)
    best = H.champions(I.metrics(official), deployable)
    return V.served(requests(spark, sf), series_rows(spark, sf), best, linear_rows(spark, sf), SMALL_FEATURES, store,
                    H.residual_quantiles(official), farm_settings(spark, sf))


@query("g17_served_requests")
def g17_served(spark, sf):
    """Champions among lines and tree learners applied to requested slots."""
    return serve(spark, sf, all_official(spark, sf, tree_predictions(spark, sf)), [*LEARNED, *X.LEARNERS], learned(spark, sf))


@query("g17_served_small_models", """
WITH q AS (SELECT series_id, horizon, model, quantile_cont(abs(y_true - y_pred), 0.95) AS q FROM b_test GROUP BY ALL HAVING count(*) >= 10),
p AS (SELECT series_id, ts, horizon, model, y_pred, rated FROM t_pred WHERE split = 'test' AND power IS NOT NULL AND wind_speed IS NOT NULL AND roll6 IS NOT NULL
  UNION ALL SELECT series_id, ts, horizon, model, y_pred, rated FROM b_pred WHERE split = 'test'),
r AS (SELECT series_id, ts, horizon FROM t_target WHERE split = 'test'
  UNION ALL SELECT 'TB99999', ts, horizon FROM t_target WHERE split = 'test' AND series_id = 'farm_total_power')
SELECT r.series_id, r.ts, r.horizon, c.model, round(CASE WHEN y_pred IS NOT NULL THEN least(greatest(y_pred, 0), rated) END, 4) AS forecast,
  round(CASE WHEN q IS NOT NULL AND y_pred IS NOT NULL THEN least(greatest(least(greatest(y_pred, 0), rated) - q, 0), rated) END, 4) AS lower,
  round(CASE WHEN q IS NOT NULL AND y_pred IS NOT NULL THEN least(greatest(least(greatest(y_pred, 0), rated) + q, 0), rated) END, 4) AS upper,
  CASE WHEN y_pred IS NULL THEN 'MISSING_MODEL' ELSE 'PASS' END AS quality_flag
FROM r LEFT JOIN b_champion c ON c.horizon = r.horizon AND c.level = CASE WHEN r.series_id LIKE 'farm%' THEN 'farm' ELSE 'turbine' END
LEFT JOIN p ON p.series_id = r.series_id AND p.ts = r.ts AND p.horizon = r.horizon AND p.model = c.model
LEFT JOIN q ON q.series_id = r.series_id AND q.horizon = r.horizon AND q.model = c.model""")
def g17_small(spark, sf):
    """The same with the small trees in place of the learners."""
    return rounded(serve(spark, sf, all_official(spark, sf, small_predictions(spark, sf)), [*LEARNED, *SMALL], small(spark, sf)))
