"""Header standardisation, wide/long reshaping and the data dictionary."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.settings import SENSORS, UNITS

TIMESTAMP_HEADER = "PCTimeStamp"
# Text inside a raw header -> sensor.
HEADER_PATTERNS = {
    "Ambient WindSpeed Avg.": "wind_speed", "Ambient Temp. Avg.": "temperature",
    "Grid Production Power Avg.": "power", "Grid Production Frequency Avg.": "frequency",
}
ROLES = {"power": "target", "wind_speed": "feature", "temperature": "feature"}


def header_parts(name: str) -> tuple[str, str, int]:
    """(turbine, sensor, sensor number) of a raw header; blanks where a part is absent."""
    turbine = name.split("_")[0] if re.match(r"TB.*_", name) else ""
    sensor = next((s for text, s in HEADER_PATTERNS.items() if text in name), "")
    number = re.search(r"\(\s*(\d+)\s*\)\s*$", name)
    return turbine, sensor, int(number.group(1)) if number else 0


def standard_names(columns: Sequence[str]) -> dict[str, str]:
    """Raw header -> standard name; of several headers for one sensor the largest number is kept."""
    chosen: dict[str, tuple[int, str]] = {}
    plain = {}
    for name in columns:
        turbine, sensor, number = header_parts(name)
        if name == TIMESTAMP_HEADER:
            plain[name] = "timestamp"
        elif turbine and sensor:
            target = f"{turbine}_{sensor}"
            if target not in chosen or number > chosen[target][0]:
                chosen[target] = (number, name)
        else:
            plain[name] = re.sub(r"[.()]", "", name.replace(" ", "_")).lower()
    return plain | {raw: target for target, (_, raw) in chosen.items()}


def standardise(df: DataFrame) -> DataFrame:
    mapping = standard_names(df.columns)
    return df.select(*[F.col(f"`{c}`").alias(mapping[c]) for c in df.columns if c in mapping])


def turbines_of(columns: Sequence[str]) -> list[str]:
    found = {c[: -len(s) - 1] for c in columns for s in SENSORS if c.startswith("TB") and c.endswith(f"_{s}")}
    return sorted(found)


def wide_to_long(df: DataFrame, ts: str = "timestamp", keep: Sequence[str] = ()) -> DataFrame:
    """One row per turbine and slot from `TBnn_<sensor>` columns, by exploding one array per row."""
    def cell(turbine: str) -> Column:
        values = [
            (F.col(f"{turbine}_{s}") if f"{turbine}_{s}" in df.columns else F.lit(None)).cast("double").alias(s)
            for s in SENSORS]
        return F.struct(F.lit(turbine).alias("turbine_id"), *values)

    cells = F.array(*[cell(t) for t in turbines_of(df.columns)])
    return df.select(*keep, F.col(ts).alias("ts"), F.explode(cells).alias("_c")).select(
        *keep, "_c.turbine_id", "ts", *[F.col(f"_c.{s}").alias(s) for s in SENSORS])


def long_to_wide(df: DataFrame, turbines: Sequence[str], ts: str = "ts", by: Sequence[str] = (),
                 column: str = "turbine_id") -> DataFrame:
    """Back to `TBnn_<sensor>` columns for the listed turbines, one row per slot (and `by`)."""
    return df.groupBy(*by, F.col(ts).alias("timestamp")).pivot(column, list(turbines)).agg(
        *[F.first(s, ignorenulls=True).alias(s) for s in SENSORS])


def data_dictionary(df: DataFrame) -> DataFrame:
    """One row per mapped raw column with name, turbine, sensor, unit, type, nulls and role."""
    mapping = standard_names(df.columns)
    types = dict(df.dtypes)
    rows = []
    for raw, name in mapping.items():
        turbine, sensor, _ = header_parts(raw)
        rows.append(F.struct(
            F.lit(raw).alias("original_column"), F.lit(name).alias("standardized_name"),
            F.lit(turbine).alias("turbine_id"), F.lit(sensor or "unknown").alias("measurement_type"),
            F.lit(UNITS.get(sensor, "unknown")).alias("unit"), F.lit(types[raw]).alias("data_type"),
            F.col(f"`{raw}`").alias("null_count"),
            F.coalesce(F.try_divide(F.col(f"`{raw}`") * 100, F.col("_rows")), F.lit(0.0)).alias("null_pct"),
            F.lit(ROLES.get(sensor, "auxiliary")).alias("role")))
    counts = df.agg(F.count("*").alias("_rows"), *[
        F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in mapping])
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def parse_target(target: Column) -> dict[str, Column]:
    """Series and horizon of a target name such as `TB02_power_target_10min`."""
    known = target.contains("_target_")
    base = F.split_part(target, F.lit("_target_"), F.lit(1))
    return {
        "base_column": base,
        "series": F.when(known, F.regexp_replace(base, "_power$", "")).otherwise("unknown"),
        "horizon": F.when(known, F.split_part(target, F.lit("_target_"), F.lit(2))).otherwise("unknown"),
    }
