"""Isolation forest and the turbine diagnostic."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.session import write_stage
from gustline.functions.measures import correlation
from gustline.functions.quantiles import exact_quantiles
from gustline.operators.boosting import MODULUS, draw, draw_sql
from gustline.operators.frozen import frozen_runs
from gustline.settings import DEFAULTS, SENSORS, FarmSettings


# ---- isolation forest

LEVELS = 8  # a tree of 256 rows ends here


def _average_path(n):
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    value = 2.0 * (np.log(np.maximum(safe - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


def _grow(x: np.ndarray, tree: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One isolation tree as arrays (feature, threshold, rows) by node, children of i at 2i and 2i + 1; feature -1 marks a leaf.

    Feature and place of a split are drawn by number of tree and node, so SQL grows the same tree from the same rows.
    """
    width = 2 << LEVELS
    feature, threshold, size = np.full(width, -1), np.zeros(width), np.zeros(width, np.int64)
    held = {1: x}
    for node in range(1, width):
        rows = held.pop(node, None)
        if rows is None:
            continue
        size[node] = len(rows)
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if node >= width // 2 or not len(open_features):
            continue
        pick = int(draw(2 * node, tree, seed)) * len(open_features) // MODULUS
        f = feature[node] = open_features[pick]
        threshold[node] = low[f] + (high[f] - low[f]) * (int(draw(2 * node + 1, tree, seed)) / MODULUS)
        left = rows[:, f] <= threshold[node]
        held |= {2 * node: rows[left], 2 * node + 1: rows[~left]}
    return feature, threshold, size


def row_number_of(keys: Sequence[str]) -> Column:
    """A 48-bit number of a row's keys, as SQL engines can compute it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def isolation_sample(filled: DataFrame, columns: Sequence[str], keys: Sequence[str], trees: int, sample: int, seed: int) -> DataFrame:
    """min(sample, n) rows for each tree: those with the smallest draws by row and tree. Only rows whose draw is under a bound that a few times `sample`
    rows pass, whatever n is, reach a tree's window."""
    total = filled.agg(F.count("*").alias("n")).first().n
    bound = int(min(1.0, (2.0 * sample + 64.0) / max(total, 1)) * MODULUS) + 1
    draws = F.array(*[F.struct(F.lit(t).alias("tree"), F.expr(draw_sql("_k", t, seed)).alias("_h")) for t in range(trees)])
    numbered = filled.select(*columns, row_number_of(keys).alias("_k"))
    per_tree = numbered.select("*", F.explode(F.filter(draws, lambda d: d["_h"] < bound)).alias("_d")).select(*columns, "_k", "_d.tree", "_d._h")
    order = Window.partitionBy("tree").orderBy("_h", "_k")
    return per_tree.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample)


def isolation_scores(df: DataFrame, columns: Sequence[str], keys: Sequence[str], trees: int = 100,
                     sample: int = 256, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """Isolation-forest score per row and a flag for the share with the highest scores.

    Each tree is grown in its own group from min(`sample`, n) rows. A tree is flat arrays of 512 nodes and the forest `trees` times that, whatever
    the number of rows; the tasks that score rows are given these arrays.
    """
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    chosen = isolation_sample(filled, columns, keys, trees, sample, seed)
    names = list(columns)

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        feature, threshold, size = _grow(rows[names].to_numpy(dtype=float), int(key[0]), seed + 3)
        return pd.DataFrame({"tree": [int(key[0])], "feature": [feature.tolist()], "threshold": [threshold.tolist()], "size": [size.tolist()]})

    grown = chosen.groupBy("tree").applyInPandas(grow, "tree int, feature array<int>, threshold array<double>, size array<bigint>")
    forest = [(np.array(r.feature), np.array(r.threshold), np.array(r["size"])) for r in grown.orderBy("tree").collect()]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expected = float(_average_path(np.mean([size[1] for _, _, size in forest])))
        for batch in batches:
            x, each = batch[names].to_numpy(dtype=float), np.arange(len(batch))
            total = np.zeros(len(x))
            for feature, threshold, size in forest:
                at, depth = np.ones(len(x), int), np.zeros(len(x))
                for _ in range(LEVELS):
                    inner = feature[at] >= 0
                    right = x[each, np.maximum(feature[at], 0)] > threshold[at]
                    at, depth = np.where(inner, 2 * at + right, at), depth + inner
                total += depth + _average_path(size[at])
            yield batch[list(keys)].assign(isolation_score=2.0 ** (-(total / len(forest)) / expected))

    types = {f.name: f for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {types[k].dataType.simpleString()}" for k in keys) + ", isolation_score double"
    scored = df.sparkSession.read.schema(schema).parquet(write_stage(filled.select(*keys, *columns).mapInPandas(score, schema), "isolation"))
    cut = exact_quantiles(scored, [], "isolation_score", [1 - contamination]).select("quantile").scalar()
    return scored.withColumn("isolation_anomaly", F.coalesce((F.col("isolation_score") > cut).cast("int"), F.lit(0)))


# ---- turbine diagnostic

PROFILE_KEYS = ("turbine_id", "split")
NO_SPREAD = 1e-12  # share of the squares below which a column counts as constant


def turbine_profile(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Missing and stopped rates, power level and frozen share of every turbine per split."""
    keys = list(PROFILE_KEYS)
    p = F.col("power")
    rates = df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[(F.avg(F.col(s).isNull().cast("int")) * 100).alias(f"missing_rate_{s}") for s in SENSORS],
        (F.count_if(p < 5) * 100 / F.count("*")).alias("stopped_rate_pct"),
        F.avg("power").alias("mean_power_kw"),
        F.stddev_pop(F.when(p > 5, p)).alias("std_power_operating"),
        F.avg(F.when(p > 5, p)).alias("mean_power_operating"),
        correlation("power", "wind_speed").alias("wind_power_corr"),
        F.avg("wind_speed").alias("mean_wind_speed"),
    )
    frozen = frozen_runs(df, keys, settings).select(*keys, "frozen_blocks", (F.col("frozen_ratio") * 100).alias("frozen_ratio_pct"))
    return rates.join(frozen, keys)


def effective_samples(rows: DataFrame) -> DataFrame:
    """Rows with and without a target per series, split and horizon."""
    return rows.groupBy("series_id", "split", "horizon").agg(
        F.count("y_true").alias("effective_samples"), F.count_if(F.col("y_true").isNull()).alias("invalid_targets"))


PAIR_SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _pair_sums(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Sums over the slots where both x of one turbine and y of another are known, for all pairs of columns."""
    kx, ky = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    x, y = np.nan_to_num(x), np.nan_to_num(y)
    return [kx.T @ ky, x.T @ ky, kx.T @ y, (x * x).T @ ky, kx.T @ (y * y), x.T @ y]


def neighbour_correlations(df: DataFrame) -> DataFrame:
    """Power and wind correlation of every turbine with each other one of its farm, per split, on shared slots.

    `df` has farm_no. The turbines of a slot are brought together once; each task then adds up products of all pairs of a farm as matrices, so a row is read once and only
    sums by pair are shuffled. Wind is compared where the turbine's own power is known too.
    """
    slots = df.groupBy("farm_no", "ts", "split").agg(F.collect_list(F.struct(
        "turbine_id", F.col("power").cast("double").alias("power"), F.col("wind_speed").cast("double").alias("wind_speed"))).alias("t"))
    names = [f"{kind}_{c}" for kind in ("p", "w") for c in PAIR_SUMS] + ["m", "s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column(2)
            slot = np.repeat(np.arange(batch.num_rows), each.value_lengths().to_numpy())
            flat = each.flatten()
            turbine = flat.field("turbine_id").dictionary_encode()
            power, wind = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("power", "wind_speed"))
            code, ids = turbine.indices.to_numpy(), turbine.dictionary.to_pylist()
            group = np.unique(np.stack([batch.column(0).to_numpy(), batch.column(1).dictionary_encode().indices.to_numpy()]), axis=1, return_inverse=True)[1].ravel()
            for g in np.unique(group):
                inside = group[slot] == g
                own, at = np.unique(code[inside], return_inverse=True)
                rows, row = np.unique(slot[inside], return_inverse=True)
                p, w, there = (np.full((len(rows), len(own)), np.nan) for _ in range(3))
                p[row, at], w[row, at], there[row, at] = power[inside], wind[inside], 1.0
                sums = [*_pair_sums(p, p), *_pair_sums(np.where(np.isnan(p), np.nan, w), w)]
                here = np.nan_to_num(there)
                sums += [here.T @ (~np.isnan(p)).astype(float), here.T @ np.nan_to_num(p)]
                i, j = np.nonzero(~np.eye(len(own), dtype=bool))
                split = batch.column(1)[int(rows[0])].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([ids[own[k]] for k in i], pa.string()), pa.array([split] * len(i), pa.string()),
                                                  pa.array([ids[own[k]] for k in j], pa.string()), *(pa.array(s[i, j]) for s in sums)], ["turbine_id", "split", "other_id", *names])

    schema = "turbine_id string, split string, other_id string, " + ", ".join(f"{c} double" for c in names)
    total = slots.select("farm_no", "split", "t").mapInArrow(run, schema).groupBy(*PROFILE_KEYS, "other_id").agg(*[F.sum(c).alias(c) for c in names])

    def corr(kind: str) -> Column:
        n, x, y, xx, yy, xy = (F.col(f"{kind}_{c}") for c in PAIR_SUMS)
        vx, vy = xx - F.try_divide(x * x, n), yy - F.try_divide(y * y, n)
        return F.when((vx > xx * NO_SPREAD) & (vy > yy * NO_SPREAD), (xy - x * y / n) / F.sqrt(vx * vy))

    return total.where(F.col("p_n") > 10).select(
        *PROFILE_KEYS, "other_id", F.col("p_n").cast("long").alias("n_shared"), corr("p").alias("power_corr"), corr("w").alias("wind_corr"),
        F.try_divide("s", "m").alias("mean_power"))


def turbine_findings(profile: DataFrame, correlations: DataFrame, metrics: DataFrame) -> DataFrame:
    """Findings per turbine and split by six thresholds, with the turbine's mean R2 over models and horizons."""
    keys = list(PROFILE_KEYS)
    near = correlations.groupBy(*keys).agg(F.avg("power_corr").alias("mean_neighbour_corr"))
    fit = metrics.groupBy(F.col("series_id").alias("turbine_id")).agg(F.avg("r2").alias("mean_r2"))
    rows = profile.join(near, keys, "left").join(fit, "turbine_id", "left")
    findings = F.array_compact(F.array(
        F.when(F.col("missing_rate_power") > 20, "HIGH_MISSING"),
        F.when(F.col("frozen_ratio_pct") > 10, "FROZEN_SIGNAL"),
        F.when(F.col("wind_power_corr") < 0.5, "LOW_WS_POWER_CORR"),
        F.when(F.col("mean_neighbour_corr") < 0.4, "LOW_NEIGHBOR_CORR"),
        F.when(F.col("stopped_rate_pct") > 30, "HIGH_STOPPED"),
        F.when(F.col("mean_power_kw") < 200, "LOW_MEAN_POWER"),
    ))
    text = F.when(F.size(findings) > 0, F.array_join(findings, "; ")).otherwise("NO_ANOMALY_DETECTED")
    return rows.withColumn("findings", text)
