"""Validation, coverage audits, data-quality report and output contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.timeline import minutes_since_epoch, with_previous
from gustline.settings import CLIP_LIMITS, DEFAULTS, REPORT_LIMITS, REPORT_UNITS, SENSORS, FarmSettings

MAX_COVERAGE_GAP = 0.05


def long_sensors(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, sensor, value): one explode, no join."""
    cells = F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(s).alias("value")) for s in SENSORS])
    return df.select(*keys, F.explode(cells).alias("_s")).select(*keys, "_s.*")


def _limits(sensor: Column, limits: dict[str, tuple[float, float]], side: int) -> Column:
    out = F.lit(None).cast("double")
    for name, pair in limits.items():
        out = F.when(sensor == name, F.lit(pair[side])).otherwise(out)
    return out


def check_timestamps(df: DataFrame, settings: FarmSettings = DEFAULTS, series: Sequence[str] = ("turbine_id",)) -> DataFrame:
    """Null, duplicate and irregular timestamps per series, with interval statistics in minutes.

    Copies of a timestamp are counted before neighbours are looked up; each is an interval of zero.
    """
    series = list(series)
    stamps = df.groupBy(*series, "ts").agg(F.count("*").alias("_c"))
    present = with_previous(stamps.where(F.col("ts").isNotNull()), series)
    gap = minutes_since_epoch(F.col("ts")) - minutes_since_epoch(F.col("previous"))
    copies = F.col("_c") - 1
    nulls = stamps.where(F.col("ts").isNull()).groupBy(*series).agg(F.sum("_c").alias("_nulls"))
    facts = present.withColumn("_gap", gap).groupBy(*series).agg(
        F.sum("_c").alias("n_rows"), F.sum(copies).alias("duplicate_timestamps"),
        (F.count_if(F.col("_gap") != settings.interval_minutes) + F.sum(copies)).alias("unusual_intervals"),
        F.when(F.sum(copies) > 0, F.lit(0)).otherwise(F.min("_gap")).cast("long").alias("min_interval"),
        F.max("_gap").alias("max_interval"),
        F.try_divide(F.sum("_gap"), F.sum("_c") - 1).alias("mean_interval"))
    return facts.join(nulls, series, "left").select(
        *series, "n_rows", F.coalesce("_nulls", F.lit(0)).alias("null_timestamps"), "duplicate_timestamps",
        "unusual_intervals", "min_interval", "max_interval", "mean_interval")


def check_ranges(df: DataFrame) -> DataFrame:
    """Out-of-range readings per turbine and sensor, only where there are any."""
    rows = long_sensors(df, ["turbine_id"]).withColumns({
        "_lo": _limits(F.col("sensor"), REPORT_LIMITS, 0), "_hi": _limits(F.col("sensor"), REPORT_LIMITS, 1)})
    out = rows.groupBy("turbine_id", "sensor").agg(
        F.count_if((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi"))).alias("out_of_range_count"),
        F.count("value").alias("n_values"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    return out.where(F.col("out_of_range_count") > 0).withColumn(
        "out_of_range_pct", F.col("out_of_range_count") * 100 / F.col("n_values"))


def check_missing(df: DataFrame) -> DataFrame:
    """Missing readings per turbine and sensor, only where there are any."""
    out = long_sensors(df, ["turbine_id"]).groupBy("turbine_id", "sensor").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("value").isNull()).alias("null_count"))
    return out.where(F.col("null_count") > 0).withColumn("null_pct", F.col("null_count") * 100 / F.col("n_rows"))


def check_power(df: DataFrame) -> DataFrame:
    return df.groupBy("turbine_id").agg(
        F.count_if(F.col("power") < 0).alias("negative_power"),
        F.count_if((F.col("wind_speed") > 25) & (F.col("power") > 100)).alias("high_wind_anomaly"))


def run_validation(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """All issues as (category, turbine_id, issue, n_rows)."""
    def issues(part: DataFrame, category: str, name: Column, n: str) -> DataFrame:
        return part.select(
            F.lit(category).alias("category"), "turbine_id", name.alias("issue"), F.col(n).cast("long").alias("n_rows"))

    stamps, power = check_timestamps(df, settings), check_power(df)
    out = issues(check_ranges(df), "value_range", F.col("sensor"), "out_of_range_count")
    out = out.unionByName(issues(check_missing(df), "missing_data", F.col("sensor"), "null_count"))
    for c in ("null_timestamps", "duplicate_timestamps", "unusual_intervals"):
        out = out.unionByName(issues(stamps.where(F.col(c) > 0), "timestamp", F.lit(c), c))
    for c in ("negative_power", "high_wind_anomaly"):
        out = out.unionByName(issues(power.where(F.col(c) > 0), "power_consistency", F.lit(c), c))
    return out


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("category").agg(F.count("*").alias("n_issues"), F.sum("n_rows").alias("n_rows"))


def timestamp_union(df: DataFrame) -> DataFrame:
    return df.select("ts").where(F.col("ts").isNotNull()).distinct()


def coverage_audit(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Rows, expected steps, gaps and coverage ratio overall, per year and per month."""
    stamps = df.where(F.col("ts").isNotNull()).groupBy("ts").agg(F.count("*").alias("_c"))
    minute = minutes_since_epoch(F.col("ts"))
    out = stamps.withColumns({"year": F.year("ts"), "month": F.month("ts")}).rollup("year", "month").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("_c") - 1).alias("n_duplicate_rows"),
        F.min("ts").alias("timestamp_start"), F.max("ts").alias("timestamp_end"),
        (F.floor((F.max(minute) - F.min(minute)) / settings.interval_minutes) + 1).alias("expected_steps"))
    label = (
        F.when(F.col("year").isNull(), "overall").when(F.col("month").isNull(), F.concat(F.lit("year_"), "year"))
        .otherwise(F.format_string("month_%d-%02d", "year", "month")))
    return out.withColumns({
        "label": label,
        "n_missing_timestamps": F.greatest(F.lit(0), F.col("expected_steps") - F.col("n_rows")),
        "coverage_ratio": F.col("n_rows") / F.col("expected_steps")}).drop("year", "month")


def synthetic_rows(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Timestamps of the processed table that no raw row has."""
    return timestamp_union(processed).join(timestamp_union(raw), "ts", "left_anti")


def synthetic_report(raw: DataFrame, processed: DataFrame, n_examples: int = 5) -> DataFrame:
    """Count and share of added timestamps with the first few as examples, null if none was added."""
    added = synthetic_rows(raw, processed)
    total = timestamp_union(processed).agg(F.count("*")).scalar()
    text = F.date_format("ts", "yyyy-MM-dd HH:mm")
    examples = added.orderBy("ts").limit(n_examples).agg(
        F.nullif(F.array_join(F.sort_array(F.collect_list(text)), ", "), F.lit(""))).scalar()
    return added.agg(F.count("*").alias("n_added")).select(
        "n_added", (F.col("n_added") / total).alias("ratio"), examples.alias("examples"))


def _remark(rate: Column) -> Column:
    return (
        F.when(rate > 50, "High missing rate - investigate").when(rate > 20, "Significant missing data")
        .when(rate > 10, "Moderate missing data").when(rate > 0, "Minor gaps").otherwise("Complete"))


def quality_report(df: DataFrame, farm: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Missing rate after the fill, invalid readings, extremes, unit and remark per sensor, plus a farm row
    and a row for the missing flags."""
    rows = long_sensors(df, ["turbine_id"]).withColumns({
        "_lo": _limits(F.col("sensor"), CLIP_LIMITS, 0), "_hi": _limits(F.col("sensor"), CLIP_LIMITS, 1)})
    unit = F.lit("check")
    for name, text in REPORT_UNITS.items():
        unit = F.when(F.col("sensor") == name, text).otherwise(unit)
    value = F.col("value")

    def facts(invalid: Column) -> list[Column]:
        return [
            (F.count_if(value.isNull()) * 100 / F.count("*")).alias("missing_rate_pct"),
            F.count_if(invalid).alias("invalid_values"), F.min(value).alias("min"), F.max(value).alias("max")]

    sensors = rows.groupBy("turbine_id", "sensor").agg(
        *facts((value < F.col("_lo")) | (value > F.col("_hi")))
    ).select(F.concat_ws("_", "turbine_id", "sensor").alias("column"), "missing_rate_pct", "invalid_values", "min",
             "max", unit.alias("unit"), _remark(F.col("missing_rate_pct")).alias("remarks"))
    total = farm.select(F.col("farm_total_power").alias("value")).agg(
        *facts((value < 0) | (value > settings.farm_rated_kw))
    ).select(F.lit("farm_total_power").alias("column"), "missing_rate_pct", "invalid_values", "min", "max",
             F.lit("kW").alias("unit"),
             F.when(F.col("missing_rate_pct") == 0, "Complete").otherwise("Minor gaps").alias("remarks"))
    flags = df.agg(F.max(F.greatest(*[f"{s}_missing" for s in SENSORS])).cast("double").alias("max"),
                   F.min(F.least(*[f"{s}_missing" for s in SENSORS])).cast("double").alias("min")).select(
        F.lit("missing flag columns").alias("column"), F.lit(None).cast("double").alias("missing_rate_pct"),
        F.lit(0).cast("long").alias("invalid_values"), "min", "max", F.lit("binary").alias("unit"),
        F.lit("Captured before the fill").alias("remarks"))
    text = {
        "definition": F.lit("missing_rate = null count after the fill / rows * 100"),
        "data_source": F.lit("cleaned table, after the fill, before features")}
    return sensors.unionByName(total).unionByName(flags).withColumns(text)


def missing_extremes(report: DataFrame, sensor: str = "wind_speed") -> DataFrame:
    """Turbines with the lowest and highest missing rate of one sensor; names break ties."""
    rows = report.where(F.col("column").endswith(f"_{sensor}")).withColumn(
        "turbine_id", F.regexp_replace("column", f"_{sensor}$", ""))
    order = F.struct("missing_rate_pct", "turbine_id")
    return rows.agg(
        F.min_by("turbine_id", order).alias("lowest"), F.min("missing_rate_pct").alias("lowest_pct"),
        F.min_by("remarks", order).alias("lowest_remarks"),
        F.max_by("turbine_id", order).alias("highest"), F.max("missing_rate_pct").alias("highest_pct"),
        F.max_by("remarks", order).alias("highest_remarks"))


def check_contract(tables: dict[str, DataFrame], required: dict[str, Sequence[str]]) -> DataFrame:
    """One row per required table: missing columns, row count, rows without samples, verdict."""
    first = next(iter(tables.values()))
    out = None
    for name, columns in required.items():
        absent = ", ".join(c for c in columns if name not in tables or c not in tables[name].columns)
        if name in tables:
            df = tables[name]
            bad = F.count_if(F.coalesce(F.col("n_samples") <= 0, F.lit(True))) if "n_samples" in df.columns else F.lit(0)
            counts = df.agg(F.count("*").alias("n_rows"), bad.cast("long").alias("n_without_samples"))
        else:
            counts = first.limit(0).agg(
                F.count("*").alias("n_rows"), F.lit(0).cast("long").alias("n_without_samples"))
        row = counts.select(F.lit(name).alias("output_table"), "n_rows", "n_without_samples",
                            F.lit(absent).alias("missing_columns"))
        out = row if out is None else out.unionByName(row)
    ok = (F.col("n_rows") > 0) & (F.col("n_without_samples") == 0) & (F.col("missing_columns") == "")
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def coverage_gap_ok(table: DataFrame) -> DataFrame:
    """Largest calibration error against the accepted gap."""
    return table.agg(F.max("calibration_error").alias("max_gap")).withColumn(
        "status", F.when(F.col("max_gap") <= MAX_COVERAGE_GAP, "PASS").otherwise("FAIL"))


def require_pass(verdicts: DataFrame) -> None:
    """Fail closed: raise with the first failing rows."""
    bad = verdicts.where(F.col("status") != "PASS").limit(20).collect()
    if bad:
        raise ValueError(f"checks failed: {bad}")


def metric_grid(metrics: DataFrame, series: DataFrame, horizons: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Expected (series, horizon, model) cells that are absent or hold a null metric.

    The grid is the series list exploded over the configured horizons and models.
    """
    grid = series.select(
        "series_id", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")
    ).select("series_id", "horizon", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    keys = ["series_id", "horizon", "model"]
    complete = metrics.where(F.col("rmse").isNotNull() & F.col("mae").isNotNull() & F.col("r2").isNotNull())
    return grid.join(complete.select(*keys), keys, "left_anti")


def target_horizons(metrics: DataFrame) -> DataFrame:
    """One row per target: how many horizons its rows name (one is right) and whether its own name ends with it."""
    named = F.bool_and(F.endswith("target", F.concat(F.lit("_target_"), "horizon")))
    facts = metrics.groupBy("target").agg(F.countDistinct("horizon").alias("n_horizons"), named.alias("named_by_horizon"))
    ok = (F.col("n_horizons") == 1) & F.col("named_by_horizon")
    return facts.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))
