"""Time splits, walk-forward and cross-validation folds, sample accounting.

On a regular grid a row's position is its slot minus the first slot, so no split needs a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.functions.timeline import slot_of
from gustline.settings import DEFAULTS, HORIZONS, FarmSettings

Bounds = tuple[Column, Column]

# Fixed values of the walk-forward scheme.
FOLD_START, FOLD_STEP = 0.25, 0.12
MIN_TRAIN, MIN_VAL, MIN_TEST = 100, 10, 10


def add_time_index(df: DataFrame, bounds: Bounds, settings: FarmSettings = DEFAULTS) -> DataFrame:
    return df.withColumn("time_index", slot_of(F.col("ts"), settings.interval_minutes) - bounds[0])


def split_by_time(df: DataFrame, bounds: Bounds, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Add `split`: train, validation or test by position on the grid."""
    n = bounds[1] - bounds[0] + 1
    position = slot_of(F.col("ts"), settings.interval_minutes) - bounds[0]
    return df.withColumn(
        "split",
        F.when(position < F.floor(n * F.lit(settings.train_ratio)), "train")
        .when(position < F.floor(n * F.lit(settings.train_ratio + settings.val_ratio)), "validation")
        .otherwise("test"),
    )


def split_by_rows(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Split irregular timestamps by distinct-timestamp position.

    Positions come from counts per day and a running total over days (one small row per day); only
    the order inside a day needs a window.
    """
    stamps = df.select("ts").distinct().withColumn("_day", F.to_date("ts"))
    days = stamps.groupBy("_day").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    total = stamps.agg(F.count("*")).scalar()
    inside = Window.partitionBy("_day").orderBy("ts")
    placed = stamps.withColumn("_rank", F.row_number().over(inside)).join(days, "_day")
    position = F.col("_before") + F.col("_rank") - 1
    named = placed.select(
        "ts",
        F.when(position < F.floor(total * F.lit(settings.train_ratio)), "train")
        .when(position < F.floor(total * F.lit(settings.train_ratio + settings.val_ratio)), "validation")
        .otherwise("test").alias("split"),
    )
    return df.join(named, "ts")


def _in_folds(df: DataFrame, bounds: Bounds, ends: list[Column], usable: Column | None,
              settings: FarmSettings) -> DataFrame:
    """Copy each row once per fold it belongs to.

    `ends` gives the positions where each part of a fold ends, from the number of slots `n`. They are
    worked out once in a one-row table and read as a scalar; rows are copied by an explode of that short
    list and never joined.
    """
    size = df.sparkSession.range(1).select((bounds[1] - bounds[0] + 1).alias("n"))
    folds = size.select(F.explode(F.array(*ends)).alias("f")).select("f.*")
    folds = folds if usable is None else folds.where(usable)
    table = folds.agg(F.sort_array(F.collect_list(F.struct(*folds.columns)))).scalar()
    position = slot_of(F.col("ts"), settings.interval_minutes) - bounds[0]
    placed = df.withColumn("_pos", position).withColumn("_f", F.explode(table))
    part = F.lit(None).cast("string")
    for name in reversed([c for c in folds.columns if c.endswith("_end")]):
        part = F.when(F.col("_pos") < F.col(f"_f.{name}"), name.removesuffix("_end")).otherwise(part)
    return placed.select(*df.columns, F.col("_f.fold").alias("fold"), part.alias("part")).where(
        F.col("part").isNotNull())


def fold_ends(n: Column, fold: int) -> Column:
    """Row positions where train, validation and test of one walk-forward fold end."""
    train = F.greatest(F.floor(n * F.lit(FOLD_START + (fold - 1) * FOLD_STEP)), F.lit(MIN_TRAIN))
    validation = F.greatest(F.floor(n * F.lit(FOLD_START + fold * FOLD_STEP)), train + 1)
    test = F.greatest(F.least(F.floor(n * F.lit(FOLD_START + (fold + 1) * FOLD_STEP)), n), validation + 1)
    return F.struct(F.lit(fold).alias("fold"), train.alias("train_end"), validation.alias("validation_end"),
                    test.alias("test_end"), n.alias("n"))


def walk_forward(df: DataFrame, bounds: Bounds, settings: FarmSettings = DEFAULTS, n_folds: int = 5) -> DataFrame:
    """One row per (input row, fold, part): expanding train, sliding validation and test; undersized folds
    are left out."""
    ends = [fold_ends(F.col("n"), i + 1) for i in range(n_folds)]
    usable = (
        (F.col("test_end") <= F.col("n")) & (F.col("train_end") >= MIN_TRAIN)
        & (F.col("validation_end") - F.col("train_end") >= MIN_VAL)
        & (F.col("test_end") - F.col("validation_end") >= MIN_TEST))
    return _in_folds(df, bounds, ends, usable, settings)


def cv_folds(df: DataFrame, bounds: Bounds, k: int = 3, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Expanding-window cross-validation: k equal test blocks at the end, train on all before."""
    n = F.col("n")
    block = F.floor(n / F.lit(k + 1))
    ends = [F.struct(
        F.lit(i + 1).alias("fold"), (n - block * (k - i)).alias("train_end"),
        (n - block * (k - i - 1)).alias("test_end")) for i in range(k)]
    return _in_folds(df, bounds, ends, None, settings)


def split_statistics(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Rows, coverage, energy and provenance per split and in total.

    Turbine rows are first reduced to one row per slot, so the counts speak of slots.
    """
    step = settings.interval_minutes
    slots = df.groupBy("split", "ts").agg(
        F.count("*").alias("_rows"), F.countDistinct("turbine_id").alias("_turbines"),
        F.sum("power").alias("_power"), F.count("power").alias("_n_power"),
        F.max("is_observed").alias("_observed"), F.max("is_imputed").alias("_imputed"),
    )
    slot = slot_of(F.col("ts"), step)
    both = slots.select("*", F.explode(F.array("split", F.lit("total"))).alias("part"))
    out = both.groupBy("part").agg(
        F.count("*").alias("rows"),
        F.min("ts").alias("timestamp_start"), F.max("ts").alias("timestamp_end"),
        (F.max(slot) - F.min(slot) + 1).alias("expected_steps"),
        F.sum((F.col("_rows") - F.col("_turbines")).cast("long")).alias("n_duplicate_timestamps"),
        F.try_divide(F.sum("_power"), F.sum("_n_power")).alias("avg_power"),
        (F.sum("_power") * step / 60000).alias("total_energy_mwh"),
        F.sum("_observed").alias("n_observed_rows"),
        F.sum(1 - F.col("_observed")).alias("n_synthetic_rows"),
        F.sum("_imputed").alias("n_imputed_rows"),
        F.count_if((F.col("_observed") == 1) & (F.col("_imputed") == 0)).alias("n_observed_not_imputed_rows"),
        F.avg(F.col("_observed").cast("double")).alias("observed_ratio"),
    )
    return out.withColumns({
        "unique_timestamps": F.col("rows"),
        "n_missing_timestamps": F.greatest(F.lit(0), F.col("expected_steps") - F.col("rows")),
        "coverage_ratio": F.col("rows") / F.col("expected_steps"),
        "avg_slot_energy_mwh": F.col("avg_power") * settings.n_turbines * step / 60000,
    })


def horizon_counts(targets: DataFrame) -> DataFrame:
    """Valid and invalid targets by split, horizon and series, from (series, split, horizon, y_true)."""
    return targets.groupBy("series_id", "split", "horizon").agg(
        F.count("*").alias("n_rows"), F.count("y_true").alias("n_valid_targets"),
        F.count_if(F.col("y_true").isNull()).alias("n_invalid_targets"),
        (F.count("y_true") / F.count("*")).alias("ratio_valid"),
    )


def horizon_valid_samples(targets: DataFrame) -> DataFrame:
    """Average, least and most valid targets over the series, per split and horizon."""
    return horizon_counts(targets).groupBy("split", "horizon").agg(
        F.avg("n_valid_targets").alias("avg_valid"), F.min("n_valid_targets").alias("min_valid"),
        F.max("n_valid_targets").alias("max_valid"),
    )


def long_targets(df: DataFrame, horizons: dict[str, int] = HORIZONS, prefix: str = "power_target_") -> DataFrame:
    """Wide target columns to one row per horizon."""
    cells = [
        F.struct(F.lit(h).alias("horizon"), F.lit(s).alias("steps"), F.col(f"{prefix}{h}").alias("y_true"))
        for h, s in horizons.items()
    ]
    kept = [c for c in df.columns if not c.startswith(prefix)]
    return df.select(*kept, F.explode(F.array(*cells)).alias("_t")).select(*kept, "_t.*")


def official_window(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Test rows before the cutoff: by flag when there is one, else by the report date."""
    if "is_simulated" in df.columns:
        return df.where(F.col("is_simulated") == 0)
    return df.where(F.col("ts") < F.lit(settings.report_date).cast("timestamp_ntz"))


def official_window_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count_if(F.col("is_simulated") == 0).alias("kept"),
        F.count_if(F.col("is_simulated") == 1).alias("excluded"),
    )
