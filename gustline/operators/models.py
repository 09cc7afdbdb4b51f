"""Forecasters: persistence, closed-form ridge and least squares, Spark ML trees, walk-forward runs.

Linear models are fitted for all series and horizons at once from sums of products, one pass over the
rows with no per-target loop. Tree ensembles use Spark ML, one fit per target.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.joins import attach
from gustline.operators.features import column_means, filled_features, training_frame
from gustline.session import write_stage
from gustline.settings import DEFAULTS, FARM_SERIES, FarmSettings

TARGET_KEYS = ("series_id", "horizon")


# ---- one-feature fits, entirely in aggregate expressions

def fit_one_feature(train: DataFrame, feature: str, alpha: float = 0.0, prefix: str = "",
                    keys: Sequence[str] = TARGET_KEYS, target: str = "y_true") -> list[Column]:
    """Aggregate columns (slope, intercept) of ridge on the standardised feature.

    `alpha = 0` is ordinary least squares. A constant feature gets slope 0.
    """
    n, std = F.count("*"), F.stddev_pop(feature)
    weight = F.try_divide(n * F.covar_pop(feature, target), std * (n + F.lit(float(alpha))))
    slope = F.coalesce(F.try_divide(weight, std), F.lit(0.0))
    return [
        slope.alias(f"{prefix}slope"),
        (F.avg(target) - slope * F.avg(feature)).alias(f"{prefix}intercept"),
    ]


# ---- many features: sums of products per key, solved per key

MATRIX_BYTES = 64 * 2 ** 20


def products(train: DataFrame, features: Sequence[str], keys: Sequence[str] = TARGET_KEYS,
             target: str = "y_true", targets: dict[str, str] | None = None) -> DataFrame:
    """(keys, cell, total, centre): sums of products of (1, features, target), upper triangle row by row.

    With `targets` (horizon -> label column) a row serves every horizon it has a label for, and `horizon` joins the keys.
    Columns are taken from their overall means, kept in `centre` of cell 0, so a small spread around a large mean is not
    lost. Each task adds up its own rows first and holds at most MATRIX_BYTES of sums before it passes them on.
    """
    labels = targets or {"": target}
    picked = list(features)
    columns = [*picked, *labels.values()]
    middle = column_means(train, columns)
    names = list(keys)
    out_names = [*names, "horizon"] if targets else names
    upper = np.triu_indices(len(picked) + 2)
    open_keys = max(1, MATRIX_BYTES // (8 * (len(picked) + 2) ** 2))

    def rows_of(sums: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(sums), columns=out_names)
        out["totals"] = [m[upper].tolist() for m in sums.values()]
        return out

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for key, part in batch.groupby(names, sort=False, dropna=False):
                values = part[columns].to_numpy(dtype=float) - middle
                x = np.column_stack([np.ones(len(part)), values[:, :len(picked)]])
                for i, horizon in enumerate(labels):
                    y = values[:, len(picked) + i]
                    known = ~np.isnan(y)
                    z = np.column_stack([x[known], y[known]])
                    at = (*key, horizon) if targets else key
                    sums[at] = sums[at] + z.T @ z if at in sums else z.T @ z
                    if len(sums) >= open_keys:
                        yield rows_of(sums)
                        sums = {}
        if sums:
            yield rows_of(sums)

    types = {f.name: f.dataType for f in train.schema.fields} | ({"horizon": T.StringType()} if targets else {})
    schema = T.StructType([
        *[T.StructField(k, types[k]) for k in out_names], T.StructField("totals", T.ArrayType(T.DoubleType()))])
    cells = train.select(*names, *[F.col(c).cast("double").alias(c) for c in columns])
    parts = cells.mapInPandas(partial, schema).select(*out_names, F.posexplode("totals").alias("cell", "part"))
    total = parts.groupBy(*out_names, "cell").agg(F.sum("part").alias("total"))
    centre = F.lit(None).cast("array<double>")
    for i, horizon in enumerate(labels):
        own = F.array(*[F.lit(float(middle[j])) for j in (*range(len(picked)), len(picked) + i)])
        centre = F.when(F.col("horizon") == horizon, own).otherwise(centre) if targets else own
    return total.withColumn("centre", F.when(F.col("cell") == 0, centre))


def _solve(cells: pd.DataFrame, size: int, choices: Sequence[Sequence[int]], alpha: float) -> list[tuple]:
    """(n, intercept, coefs) for each choice of feature positions, in raw units."""
    upper = np.triu_indices(size + 2)
    flat = np.zeros(len(upper[0]))
    flat[cells.cell] = cells.total
    gram = np.zeros((size + 2, size + 2))
    gram[upper] = flat
    gram += np.triu(gram, 1).T
    centre = np.asarray(cells.centre[cells.cell == 0].iloc[0], dtype=float)
    n, y_sum = gram[0, 0], gram[0, -1]
    out = []
    for picked in choices:
        at = np.array(picked) + 1
        mean = gram[0, at] / n
        raw = mean + centre[picked]
        cross = gram[np.ix_(at, at)] - n * np.outer(mean, mean)
        to_y = gram[at, -1] - mean * y_sum
        scale = np.sqrt(np.maximum(np.diag(cross) / n, 0.0))
        scale[scale < 1e-9 * np.maximum(1.0, np.abs(raw))] = 1.0
        system = cross / np.outer(scale, scale) + alpha * np.eye(len(at))
        right = to_y / scale
        weight = np.linalg.solve(system, right) if alpha else np.linalg.lstsq(system, right, rcond=None)[0]
        coefs = weight / scale
        out.append((int(n), float(y_sum / n + centre[-1] - coefs @ raw), coefs))
    return out


def solve_blocks(sums: DataFrame, features: Sequence[str], blocks: dict[str, Sequence[str] | dict[str, Sequence[str]]],
                 alpha: float = 0.0, keys: Sequence[str] = TARGET_KEYS) -> DataFrame:
    """(keys, feature_set, n, intercept, coefs) of every block from one set of sums of products.

    Ridge on population-standardised features, given back in raw units. `features` is the order the sums were taken
    in and the order of `coefs`, with 0 for features outside the block. A block may name its features per horizon. Each
    solve reads (features + 2)^2 / 2 numbers however many rows there are.
    """
    names, order = list(keys), list(features)

    def solve(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        own = dict(zip(names, key, strict=True))
        choices = {name: [order.index(f) for f in (block[own["horizon"]] if isinstance(block, dict) else block)]
                   for name, block in blocks.items()}
        rows = []
        for (name, picked), (n, intercept, coefs) in zip(
                choices.items(), _solve(cells, len(order), list(choices.values()), alpha), strict=True):
            padded = np.zeros(len(order))
            padded[picked] = coefs
            rows.append({**own, "feature_set": name, "n": n, "intercept": intercept, "coefs": padded.tolist()})
        return pd.DataFrame(rows)

    types = {f.name: f.dataType for f in sums.schema.fields}
    schema = T.StructType([
        *[T.StructField(k, types[k]) for k in names], T.StructField("feature_set", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType()),
        T.StructField("coefs", T.ArrayType(T.DoubleType()))])
    return sums.groupBy(*names).applyInPandas(solve, schema)


def fit_linear(train: DataFrame, features: Sequence[str], alpha: float = 0.0,
               keys: Sequence[str] = TARGET_KEYS, target: str = "y_true") -> DataFrame:
    """Ridge (or least squares at `alpha = 0`) on the complete rows of every key."""
    rows = training_frame(train, features, target)
    sums = products(rows, features, keys, target)
    return solve_blocks(sums, features, {"all": features}, alpha, keys).drop("feature_set")


def dot(coefs: str, features: Sequence[str]) -> Column:
    """Sum of coefficient times feature.

    The terms go through an array: a long written-out sum would outgrow what the JVM compiles.
    """
    values = [F.col(f).cast("double") for f in features]
    terms = F.zip_with(F.col(coefs), F.array(*values), lambda a, b: a * b)
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)


def predict_linear(df: DataFrame, fits: DataFrame, features: Sequence[str], name: str,
                   keys: Sequence[str] = TARGET_KEYS, fill: bool = False) -> DataFrame:
    """Add the dot product with the fitted coefficients; `fill` counts a missing feature as 0."""
    source = filled_features(df, features) if fill else df
    guess = F.col("_intercept") + dot("_coefs", features)
    picked = fits.select(*keys, F.col("intercept").alias("_intercept"), F.col("coefs").alias("_coefs"))
    return attach(source, picked, keys).select(*df.columns, guess.alias(name))


# ---- the long prediction table

# What each closed-form model reads; fits, scores and the registry all use this table.
BASE_FEATURES = {"persistence": "power", "ridge": "power", "linear_wind": "wind_speed", "linear_roll": "roll6"}
BASE_ALPHAS = {"ridge": 1.0, "linear_wind": 0.0, "linear_roll": 0.0}
BASE_MODELS = tuple(BASE_FEATURES)


def rated_power(series: Column, settings: FarmSettings = DEFAULTS) -> Column:
    return F.when(series == FARM_SERIES, F.lit(settings.farm_rated_kw)).otherwise(F.lit(settings.rated_kw))


def base_predictions(rows: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Long table of four closed-form models fitted on the training rows of every series and horizon.

    `rows` is (series_id, ts, split, horizon, power, wind_speed, roll6, y_true, flags). All models share
    the complete rows; one grouped pass fits them and one join scores them.
    """
    used = list(dict.fromkeys(BASE_FEATURES.values()))
    complete = training_frame(rows.where(F.col("split") == "train"), used, "y_true")
    fits = complete.groupBy(*TARGET_KEYS).agg(*[
        c for model, alpha in BASE_ALPHAS.items()
        for c in fit_one_feature(complete, BASE_FEATURES[model], alpha, f"{model}_")])

    def guess(model: str) -> Column:
        x = F.col(BASE_FEATURES[model])
        return F.col(f"{model}_intercept") + F.col(f"{model}_slope") * x if model in BASE_ALPHAS else x

    models = F.array(*[F.struct(F.lit(m).alias("model"), guess(m).alias("y_pred")) for m in BASE_FEATURES])
    joined = attach(rows, fits, TARGET_KEYS)
    return joined.select(
        *rows.columns, rated_power(F.col("series_id"), settings).alias("rated"), F.explode(models).alias("_m")
    ).select(*rows.columns, "rated", "_m.model", "_m.y_pred")


def base_registry(predictions: DataFrame) -> DataFrame:
    """One row per fitted closed-form model: its target, the features its fit reads and how many forecasts it gave."""
    features = F.element_at(F.create_map(*[
        c for m, f in BASE_FEATURES.items() for c in (F.lit(m), F.array(F.lit(f)))]), F.col("model"))
    rows = predictions.groupBy(*TARGET_KEYS, "model").agg(F.count("y_pred").alias("n_scored"))
    return rows.withColumns({"target": F.concat("series_id", F.lit("_target_"), "horizon"), "features": features})


def as_model(df: DataFrame, name: str, prediction: str) -> DataFrame:
    """Append one more model's column as rows of the long table's shape."""
    return df.withColumn("model", F.lit(name)).withColumnRenamed(prediction, "y_pred")


# ---- Spark ML trees

@dataclass(frozen=True)
class TreePreset:
    """Hyperparameters of one tree learner."""

    kind: str
    trees: int
    depth: int
    options: dict = field(default_factory=dict)

    def estimator(self, label: str, seed: int):
        common = {"featuresCol": "features", "labelCol": label, "maxDepth": self.depth, "seed": seed, **self.options}
        if self.kind == "forest":
            return RandomForestRegressor(numTrees=self.trees, **common)
        return GBTRegressor(maxIter=self.trees, **common)


# Tree counts, depths and rates of the three learners.
PRESETS = {
    "random_forest": TreePreset("forest", 80, 10, {"featureSubsetStrategy": "0.5", "minInstancesPerNode": 10}),
    "gbt_a": TreePreset("boosted", 150, 6, {"stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5"}),
    "gbt_b": TreePreset("boosted", 150, 6, {"stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5",
                                            "maxBins": 64}),
}


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(df)


def fit_tree(train: DataFrame, features: Sequence[str], preset: TreePreset, label: str = "y_true",
             seed: int = 42) -> PipelineModel:
    """Assembler and fitted learner. Every tree level is a job over the training rows, so these are first laid out in
    partitions of the advisory size: few for a small input, many for a large one.
    """
    used = training_frame(train, features, label).select(*features, label)
    rows = assemble(used.hint("rebalance"), features)
    return PipelineModel([VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
                          preset.estimator(label, seed).fit(rows)])


def predict_tree(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scoring rows keep their place: a missing feature counts as 0."""
    return model.transform(filled_features(df, features)).drop("features")


def fit_scores(scored: DataFrame, truth: str = "y_true", guess: str = "prediction") -> DataFrame:
    e = F.col(guess) - F.col(truth)
    rows = scored.where(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    return rows.agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(truth) * F.count("*"))).alias("r2"),
        F.count("*").alias("n_samples"),
    )


def grid_search(folds: DataFrame, features: Sequence[str], grid: Sequence[TreePreset], label: str = "y_true",
                seed: int = 42, parallel: int = 8) -> DataFrame:
    """One record per preset and time-ordered fold; `folds` has (fold, part) columns."""
    spark = folds.sparkSession
    rows = folds.persist()
    ids = [r.fold for r in rows.select("fold").distinct().collect()]
    cells = [(i, preset, fold) for i, preset in enumerate(grid) for fold in sorted(ids)]

    def run(cell):
        i, preset, fold = cell
        own = rows.where(F.col("fold") == fold)
        model = fit_tree(own.where("part = 'train'"), features, preset, label, seed)
        score = fit_scores(predict_tree(model, own.where("part = 'test'"), features), label).first()
        return (i, preset.kind, preset.trees, preset.depth, float(preset.options.get("stepSize", 0.0)), fold,
                score.rmse, score.n_samples)

    try:
        with ThreadPoolExecutor(parallel) as pool:
            done = list(pool.map(run, cells))
    finally:
        rows.unpersist()
    return spark.createDataFrame(
        done, "candidate int, kind string, trees int, depth int, step double, fold int, rmse double, n_samples long")


def grid_summary(records: DataFrame) -> DataFrame:
    """Mean RMSE per preset; the least mean is best, the earlier preset on ties."""
    means = records.groupBy("candidate", "kind", "trees", "depth", "step").agg(
        F.avg("rmse").alias("mean_rmse"), F.count("rmse").alias("n_folds"))
    best = means.agg(F.min_by("candidate", F.struct("mean_rmse", "candidate"))).scalar()
    return means.withColumn("is_best", F.col("candidate") == best)


def refit_best(rows: DataFrame, features: Sequence[str], grid: Sequence[TreePreset], summary: DataFrame,
               label: str = "y_true", seed: int = 42) -> PipelineModel:
    """The best preset fitted on training and validation rows together."""
    best = summary.where("is_best").select("candidate").first().candidate
    return fit_tree(rows.where("split in ('train', 'validation')"), features, grid[best], label, seed)


# ---- walk-forward

def walk_forward_scores(folds: DataFrame, feature: str = "power", alpha: float = 1.0) -> DataFrame:
    """Persistence and one-feature ridge on the validation part of each fold, per series and horizon.

    `folds` is (series_id, horizon, fold, part, feature, y_true); all folds are fitted in one pass.
    """
    keys = ["series_id", "horizon", "fold"]
    train = training_frame(folds.where("part = 'train'"), [feature], "y_true")
    fits = train.groupBy(*keys).agg(*fit_one_feature(train, feature, alpha))
    val = training_frame(folds.where("part = 'validation'"), [feature], "y_true")
    models = F.array(
        F.struct(F.lit("persistence").alias("model"), F.col("power").alias("y_pred")),
        F.struct(F.lit("ridge").alias("model"), (F.col("intercept") + F.col("slope") * F.col(feature)).alias("y_pred")),
    )
    scored = attach(val, fits, keys).select(*keys, "y_true", F.explode(models).alias("_m")).select(*keys, "y_true", "_m.*")
    e = F.col("y_pred") - F.col("y_true")
    return scored.groupBy(*keys, "model").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.coalesce(1 - F.try_divide(F.sum(e * e), F.var_pop("y_true") * F.count("*")), F.lit(0.0)).alias("r2"),
        F.count("*").alias("n_samples"),
    )


def walk_forward_summary(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("rmse").isNotNull()).groupBy("model", "horizon").agg(
        F.avg("rmse").alias("rmse_mean"), F.stddev_samp("rmse").alias("rmse_std"),
        F.avg("r2").alias("r2_mean"), F.stddev_samp("r2").alias("r2_std"),
        F.countDistinct("fold").alias("n_folds"), F.count("*").alias("n_evaluations"),
    )


# ---- experiments

def compare_linear(rows: DataFrame, blocks: dict[str, Sequence[str] | dict[str, Sequence[str]]], alpha: float = 1.0,
                   settings: FarmSettings = DEFAULTS, targets: dict[str, str] | None = None) -> DataFrame:
    """Ridge per feature block, all blocks trained and scored on the same complete rows.

    The sums of products are taken once for all features; a block solves its part of them, and one pass over the test
    rows scores every block. `rows` has one row per horizon, or with `targets` (horizon -> label column) one row for all.
    """
    lists = [f for b in blocks.values() for f in (b.values() if isinstance(b, dict) else [b])]
    everything = list(dict.fromkeys(f for names in lists for f in names))
    spark = rows.sparkSession
    complete = rows.dropna(subset=everything if targets else [*everything, "y_true"])
    keys = [k for k in TARGET_KEYS if not targets or k != "horizon"]
    sums = products(complete.where("split = 'train'"), everything, keys, targets=targets)
    sums = spark.read.schema(sums.schema).parquet(write_stage(sums, "products"))
    fits = solve_blocks(sums, everything, blocks, alpha).select(*TARGET_KEYS, "feature_set", "intercept", "coefs")
    test = complete.where("split = 'test'")
    if targets:
        cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(c).alias("y_true")) for h, c in targets.items()])
        test = test.select("series_id", *everything, F.explode(cells).alias("_t")).select("series_id", *everything, "_t.*")
    known = test.select(*TARGET_KEYS, *everything, "y_true").where(F.col("y_true").isNotNull())
    guess = F.col("intercept") + dot("coefs", everything)
    e = guess - F.col("y_true")
    long = attach(known, fits, TARGET_KEYS).select(*TARGET_KEYS, "feature_set", "y_true", e.alias("e"))
    e = F.col("e")
    return long.groupBy(*TARGET_KEYS, "feature_set").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop("y_true") * F.count("*"))).alias("r2"),
        F.count("*").alias("n_samples"),
    ).withColumn("nmae_pct", F.col("mae") / rated_power(F.col("series_id"), settings) * 100)


def ablation_blocks(features: Sequence[str]) -> dict[str, list[str]]:
    """The full feature list and the same without one kind of feature."""
    kinds = {
        "without_lag": ("_lag",), "without_rolling": ("_roll",),
        "without_interaction": ("farm_avg", "power_per_wind"), "without_weather": ("wind_speed", "temperature", "nwp_"),
    }
    blocks = {"all": list(features)}
    for name, marks in kinds.items():
        blocks[name] = [f for f in features if not any(m in f for m in marks)]
    return {name: block for name, block in blocks.items() if block}


# ---- storage and batch scoring

def config_hash(settings: FarmSettings) -> str:
    """First 16 hexadecimal digits of the SHA-256 of the settings as sorted JSON."""
    return hashlib.sha256(json.dumps(asdict(settings), sort_keys=True).encode()).hexdigest()[:16]


def data_hash(df: DataFrame) -> str:
    """16 hexadecimal digits that depend on the rows, not on their order or files."""
    wide = F.xxhash64(*df.columns).cast("decimal(38,0)")
    row = df.agg(F.count("*").alias("n"), F.sum(wide).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), *df.columns)).alias("x")).first()
    return hashlib.sha256(f"{row.n},{row.s},{row.x}".encode()).hexdigest()[:16]


def save_model(spark: SparkSession, model: PipelineModel, folder: str, key: str, features: Sequence[str],
               meta: dict[str, str]) -> None:
    """Model files plus one registry row (features, seed, hashes and so on)."""
    model.write().overwrite().save(f"{folder}/{key}")
    row = spark.createDataFrame(
        [(key, f"{folder}/{key}", list(features), meta)],
        "model_key string, path string, features array<string>, meta map<string,string>")
    row.write.mode("append").parquet(f"{folder}/registry")


def load_model(spark: SparkSession, folder: str, key: str) -> tuple[PipelineModel, list[str]]:
    row = spark.read.parquet(f"{folder}/registry").where(F.col("model_key") == key).first()
    if row is None:
        raise KeyError(key)
    return PipelineModel.load(row.path), list(row.features)


def load_meta(spark: SparkSession, folder: str, key: str) -> dict[str, str]:
    return dict(spark.read.parquet(f"{folder}/registry").where(F.col("model_key") == key).first().meta)


def champion_scores(requests: DataFrame, predictions: DataFrame, champions: DataFrame,
                    quantiles: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Forecasts of the champion for the requested (series_id, ts, horizon).

    Clamped to the rated power, with the champion's residual quantile as interval. A request without a
    prediction is returned and flagged.
    """
    level = F.when(F.col("series_id") == FARM_SERIES, "farm").otherwise("turbine")
    wanted = attach(
        requests.withColumn("level", level), champions.select("level", "horizon", "model"), ["level", "horizon"], "left")
    scored = wanted.join(
        predictions.select("series_id", "ts", "horizon", "model", "y_pred"),
        ["series_id", "ts", "horizon", "model"], "left")
    keyed = attach(scored, quantiles.select("series_id", "horizon", "model", "q"), ["series_id", "horizon", "model"], "left")
    rated = rated_power(F.col("series_id"), settings)
    zero = F.lit(0.0)

    def clamped(c: Column) -> Column:
        return F.when(c.isNotNull(), F.least(F.greatest(c, zero), rated))

    value = clamped(F.col("y_pred"))
    return keyed.select(
        "series_id", "ts", "horizon", "model", value.alias("forecast"),
        clamped(value - F.col("q")).alias("lower"), clamped(value + F.col("q")).alias("upper"),
        F.when(F.col("y_pred").isNull(), "MISSING_MODEL").otherwise("PASS").alias("quality_flag"),
    )
