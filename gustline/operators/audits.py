"""Leakage audits, sample traces and the table inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.operators.features import MARKERS, META_COLUMNS
from gustline.settings import DEFAULTS, FarmSettings

# Name parts that stand for later information in a frame audit.
LATER_NAMES = ("timestamp", "future", "lookahead", "issue", "prediction")


def name_audit(registry: DataFrame, markers: Sequence[str] = MARKERS) -> DataFrame:
    """Features of each registered model that carry a forbidden marker; `registry` has a features array."""
    def marked(f: Column) -> Column:
        hit = F.lit(False)
        for m in markers:
            hit = hit | f.contains(m)
        return hit

    bad = F.filter("features", marked)
    return registry.withColumns({
        "n_features": F.size("features"), "leaky_features": F.array_join(F.array_sort(bad), ", "),
        "status": F.when(F.size(bad) == 0, "PASS").otherwise("FAIL")})


def feature_evidence(registry: DataFrame) -> DataFrame:
    """Feature list per model, whether its own target or any target is among them."""
    return registry.withColumns({
        "feature_list": F.array_join("features", ", "),
        "target_in_features": F.array_contains("features", F.col("target")),
        "any_future_target": F.exists("features", lambda f: f.contains("_target_"))})


def leakage_assertions(predictions: DataFrame, series: DataFrame, registry: DataFrame,
                       settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Assertions per (series, horizon, model).

    The truth scored must equal the series' reading at issue time plus horizon (looked up again by time),
    the forecast must not equal the truth on every row, and no feature may be a target or a row
    description.
    """
    keys = ["series_id", "horizon", "model"]
    later = series.select("series_id", F.col("ts").alias("_target_ts"), F.col("power").alias("_reading"))
    moved = predictions.withColumn(
        "_target_ts", F.col("ts") + F.make_dt_interval(mins=(F.col("steps") * settings.interval_minutes).cast("int")))
    joined = moved.join(later, ["series_id", "_target_ts"], "left")
    y, p = F.col("y_true"), F.col("y_pred")
    close = F.abs(p - y) <= 1e-8 + 1e-5 * F.abs(y)
    facts = joined.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.bool_and(y.eqNullSafe(F.col("_reading"))).alias("target_time_ok"),
        F.coalesce(~F.bool_and(close), F.lit(True)).alias("prediction_differs"))
    meta = F.exists("features", lambda f: f.isin(*META_COLUMNS))
    names = registry.select(
        "model", (~F.exists("features", lambda f: f.contains("_target_"))).alias("target_not_in_features"),
        (~meta).alias("no_meta_column")).distinct()
    out = facts.join(names, "model", "left")
    ok = F.col("target_time_ok") & F.col("prediction_differs") & F.col("target_not_in_features") & F.col("no_meta_column")
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def frame_audit(frame: DataFrame, features: Sequence[str], target: str, issue: str, due: str,
                keys: Sequence[str], model: str) -> DataFrame:
    """Names, matching row counts, target after issue and repeated rows of one model's training frame of every key.

    Repeats are counted by grouping on the whole row, which combines copies before the shuffle.
    """
    target_in = any("target" in f.lower() for f in features)
    later_in = any(m in f.lower() for f in features for m in LATER_NAMES)
    groups = frame.groupBy(*[c for c in frame.columns]).agg(F.count("*").alias("_c"))
    facts = groups.groupBy(*keys).agg(
        F.sum("_c").alias("n_rows"), F.sum(F.col("_c") - 1).alias("n_duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col(target).isNull(), F.col("_c"))), F.lit(0)).alias("n_without_target"),
        F.bool_and(F.col(due) > F.col(issue)).alias("target_after_issue"))
    ok = (F.col("n_duplicate_rows") == 0) & (F.col("n_without_target") == 0) & F.col("target_after_issue")
    return facts.select(
        F.lit(model).alias("model"), *keys, "n_rows", "n_duplicate_rows", "n_without_target", "target_after_issue",
        F.lit(not target_in).alias("target_not_in_features"), F.lit(not later_in).alias("no_later_names"),
        F.when(ok & F.lit(not target_in and not later_in), "PASS").otherwise("FAIL").alias("status"))


def sample_trace(features: DataFrame, predictions: DataFrame, series_id: str, horizon: str, shown: Sequence[str],
                 models: Sequence[str], settings: FarmSettings = DEFAULTS, n: int = 200) -> DataFrame:
    """First n complete rows of one forecast: issue and target time, features, target, every model."""
    own = predictions.where((F.col("series_id") == series_id) & (F.col("horizon") == horizon))
    wide = own.groupBy("ts", "steps", "y_true").pivot("model", list(models)).agg(F.first("y_pred"))
    mine = features.where(F.col("turbine_id") == series_id).select("ts", *shown)
    due = F.col("ts") + F.make_dt_interval(mins=(F.col("steps") * settings.interval_minutes).cast("int"))
    joined = mine.join(wide, "ts").dropna(subset=[*shown, "y_true", *models])
    return joined.select(
        F.col("ts").alias("timestamp_issue"), due.alias("timestamp_target"), *shown, F.col("y_true").alias("target"),
        *[F.col(m).alias(f"pred_{m}") for m in models]).orderBy("timestamp_issue").limit(n)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("output_table"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
