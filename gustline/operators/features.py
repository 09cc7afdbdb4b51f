"""Lag, rolling, change, calendar, ramp, interaction and weather features; targets; feature choice.

Functions named `*_columns` return `{name: Column}` for one window, so that a feature matrix needs a
single shuffle and sort however many features it holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.functions.timeline import over_slots
from gustline.operators.cleaning import fill_stage
from gustline.settings import DEFAULTS, HORIZONS, SENSORS, FarmSettings

# Substrings of names that must not be features, and row descriptions.
MARKERS = ("_target_", "_missing", "_status", "_is_anomaly", "_anomaly_score", "_is_stopped", "_failure_event")
META_COLUMNS = ("turbine_id", "series_id", "ts", "time_index", "split", "status", "is_observed",
                "is_synthetic", "is_imputed", "is_simulated")


def lag_columns(w: WindowSpec, names: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    return {f"{c}_lag{k}": F.lag(c, k).over(w) for c in names for k in lags}


def rolling_stages(names: Sequence[str], windows: Sequence[int]) -> list:
    """Mean, sample std, min and max of the previous w slots, the current one excluded.

    The smallest window is read directly. A window that is a multiple of the one before it is put
    together from shifted copies of that one (counts, sums, squared deviations, extremes), so 144
    slots cost a few lookups per row instead of 144 reads.
    """
    sizes = sorted(windows)

    def parts(c: str, w: int) -> list[str]:
        return [f"_{c}_{w}_{part}" for part in ("n", "sum", "m2", "min", "max")]

    def direct(w: int):
        def stage(window):
            out = {}
            for c in names:
                n, total, m2, low, high = parts(c, w)
                reach = window.rowsBetween(-w, -1)
                out |= {
                    n: F.count(c).over(reach),
                    total: F.coalesce(F.sum(c).over(reach), F.lit(0.0)),
                    m2: F.coalesce(F.var_pop(c).over(reach) * F.count(c).over(reach), F.lit(0.0)),
                    low: F.min(c).over(reach),
                    high: F.max(c).over(reach),
                }
            return out
        return stage

    def shifted(small: int, w: int):
        # One look-up per shift brings the parts of every column.
        def stage(window):
            packed = F.struct(*[F.col(name) for c in names for name in parts(c, small)])
            return {f"_{small}_{k}": F.lag(packed, k * small).over(window) for k in range(1, w // small)}
        return stage

    def merged(small: int, w: int):
        def copies(name):
            return [F.col(name)] + [F.col(f"_{small}_{k}").getField(name) for k in range(1, w // small)]

        def sums(_):
            out = {}
            for c in names:
                n, total, _m2, low, high = (copies(name) for name in parts(c, small))
                out |= {
                    f"_{c}_{w}_n": sum((F.coalesce(x, F.lit(0)) for x in n), F.lit(0)),
                    f"_{c}_{w}_sum": sum((F.coalesce(x, F.lit(0.0)) for x in total), F.lit(0.0)),
                    f"_{c}_{w}_min": F.least(*low),
                    f"_{c}_{w}_max": F.greatest(*high),
                }
            return out

        def spreads(_):
            out = {}
            for c in names:
                n, total, m2, _low, _high = (copies(name) for name in parts(c, small))
                mean = F.try_divide(F.col(f"_{c}_{w}_sum"), F.col(f"_{c}_{w}_n"))
                spread = sum((F.coalesce(x, F.lit(0.0)) for x in m2), F.lit(0.0))
                for size, part in zip(n, total, strict=True):
                    gap = F.try_divide(part, size) - mean
                    spread = spread + F.coalesce(size * gap * gap, F.lit(0.0))
                out[f"_{c}_{w}_m2"] = spread
            return out
        return [sums, spreads]

    def finished(w: int):
        def stage(_):
            out = {}
            for c in names:
                n, total, m2, low, high = (F.col(x) for x in parts(c, w))
                out |= {
                    f"{c}_roll{w}_mean": F.try_divide(total, n),
                    f"{c}_roll{w}_std": F.when(n > 1, F.sqrt(m2 / (n - 1))),
                    f"{c}_roll{w}_min": low,
                    f"{c}_roll{w}_max": high,
                }
            return out
        return stage

    def together(*parts_):
        def stage(window):
            return {name: c for part in parts_ for name, c in part(window).items()}
        return stage

    # What a window publishes and what the next one looks up need only the sums so far: one step.
    stages, previous, pending = [], None, []
    for w in sizes:
        if previous and w % previous == 0:
            stages += [together(*pending, shifted(previous, w)), *merged(previous, w)]
        else:
            stages.append(together(*pending, direct(w)))
        pending, previous = [finished(w)], w
    return [*stages, together(*pending)]


def change_columns(w: WindowSpec, names: Sequence[str]) -> dict[str, Column]:
    """Differences over 1, 3 and 6 slots and the relative change over one.

    Growth from zero has no finite value and is given as 0; 0 to 0 stays null.
    """
    out = {}
    for c in names:
        out |= {f"{c}_diff{k}": F.col(c) - F.lag(c, k).over(w) for k in (1, 3, 6)}
        before = F.lag(c, 1).over(w)
        out[f"{c}_pctchange1"] = F.when((before == 0) & (F.col(c) != 0), F.lit(0.0)).otherwise(
            F.try_divide(F.col(c), before) - 1
        )
    return out


def ramp_columns(
    w: WindowSpec, names: Sequence[str], settings: FarmSettings = DEFAULTS, rated_kw: float | None = None
) -> dict[str, Column]:
    limit = (rated_kw or settings.rated_kw) * settings.ramp_pct_per_min / 100
    out = {}
    for c in names:
        rate = (F.col(c) - F.lag(c, 1).over(w)) / settings.interval_minutes
        out |= {
            f"{c}_ramp": rate,
            f"{c}_ramp_abs": F.abs(rate),
            f"{c}_ramp_up": F.coalesce((rate > limit).cast("int"), F.lit(0)),
            f"{c}_ramp_down": F.coalesce((rate < -limit).cast("int"), F.lit(0)),
        }
    return out


def target_columns(w: WindowSpec, power: str = "power", horizons: dict[str, int] = HORIZONS) -> dict[str, Column]:
    return {f"{power}_target_{name}": F.lead(power, steps).over(w) for name, steps in horizons.items()}


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), 1).when(month.between(6, 8), 2).when(month.between(9, 11), 3).otherwise(4)
    )


def calendar_columns(ts: str = "ts") -> dict[str, Column]:
    c = F.col(ts)
    hour, dow, month = F.hour(c), F.weekday(c), F.month(c)

    def turn(value: Column, period: int) -> Column:
        return value * (2 * F.pi() / period)

    return {
        "hour_of_day": hour, "day_of_week": dow, "month": month, "day_of_year": F.dayofyear(c),
        "is_weekend": (dow >= 5).cast("int"),
        "hour_sin": F.sin(turn(hour, 24)), "hour_cos": F.cos(turn(hour, 24)),
        "month_sin": F.sin(turn(month, 12)), "month_cos": F.cos(turn(month, 12)),
        "dow_sin": F.sin(turn(dow, 7)), "dow_cos": F.cos(turn(dow, 7)),
        "season": season(month),
    }


def with_interactions(df: DataFrame, farm: DataFrame) -> DataFrame:
    """Farm means joined on the slot, and power per unit of wind (null at zero wind).

    The means are stored first: one row per slot, broadcast as soon as the join is planned, so that the wide rows are not shuffled by slot.
    """
    means = farm.select("ts", "farm_avg_power", F.col("farm_avg_wind_speed").alias("farm_avg_wind"))
    return attach(df, means, ["ts"], "left").withColumn(
        "power_per_wind", F.try_divide(F.col("power"), F.nullif(F.col("wind_speed"), F.lit(0.0)))
    )


def window_features(
    df: DataFrame,
    settings: FarmSettings = DEFAULTS,
    sensors: Sequence[str] = ("power", "wind_speed", "temperature"),
    horizons: dict[str, int] | None = None,
    series: str = "turbine_id",
    span: int | None = None,
    fill: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Every windowed feature and target in one pass: one shuffle, one sort.

    With `fill` the frame is an unfilled grid and the bounded fill happens in the same pass.
    """
    horizons = HORIZONS if horizons is None else horizons
    sensors = [s for s in sensors if s in df.columns]
    power = [s for s in ("power",) if s in df.columns]

    def simple(w):
        return {
            **lag_columns(w, sensors, settings.lags),
            **change_columns(w, power),
            **ramp_columns(w, power, settings),
            **(target_columns(w, "power", horizons) if power else {}),
        }

    back = max([*settings.lags, *settings.windows, 6])
    first = [fill_stage(settings, [s for s in SENSORS if s in df.columns])] if fill else []
    return over_slots(
        df, [series], settings.interval_minutes, back + (settings.max_fill_slots if fill else 0),
        max(horizons.values(), default=0), [*first, simple, *rolling_stages(sensors, settings.windows)], span=span, tasks=tasks,
    )


def feature_matrix(df: DataFrame, farm: DataFrame, settings: FarmSettings = DEFAULTS,
                   turbine_id: str | None = None, horizons: dict[str, int] | None = None) -> DataFrame:
    """Per-turbine feature rows (`scope = own`), of one turbine when named."""
    chosen = df.where(F.col("turbine_id") == turbine_id) if turbine_id else df
    windowed = window_features(chosen, settings, horizons=horizons)
    return with_interactions(windowed.withColumns(calendar_columns()), farm)


OTHER_PLACES = 3


def farm_scope_matrix(df: DataFrame, places: Sequence[str], settings: FarmSettings = DEFAULTS, horizons: dict[str, int] | None = None) -> DataFrame:
    """One row per farm and slot: power features of all its turbines side by side, wind and temperature of the first three; with
    `horizons` also the power of these places together and its targets.

    `df` has farm_no and place; the listed places become columns, so the width is that of one farm. The readings of a farm and slot
    meet first and the windows run over all places at once: readings are shuffled, features are not.
    """
    power = [(p, "power") for p in places]
    other = [(p, s) for p in list(places)[:OTHER_PLACES] for s in ("wind_speed", "temperature")]
    cells, powers = [f"{p}_{s}" for p, s in [*power, *other]], [f"{p}_power" for p in places]

    def simple(w):
        return {**lag_columns(w, cells, settings.lags), **change_columns(w, powers), **ramp_columns(w, powers, settings),
                **target_columns(w, "power", horizons or {})}

    def of(place: str, value: Column) -> Column:
        return F.max(F.when(F.col("place") == place, value))

    meet = [*[of(p, F.col(s)).alias(f"{p}_{s}") for p, s in [*power, *other]], *[of(p, F.lit(True)).alias(f"{p}_held") for p in places],
            F.sum("power").alias("power")]
    readings = df.where(F.col("place").isin(*places)).select("farm_no", "place", "ts", "power", "wind_speed", "temperature")
    rows = over_slots(
        readings, ["farm_no"], settings.interval_minutes, max([*settings.lags, *settings.windows, 6]),
        max((horizons or {}).values(), default=0), [simple, *rolling_stages(cells, settings.windows)], meet=meet)
    # a place without a row at a slot has no features there
    features = [F.when(F.col(f"{p}_held"), F.col(c)).alias(c) for pairs in (power, other) for p in dict.fromkeys(p for p, _ in pairs)
                for c in rows.columns if c.startswith(tuple(f"{p}_{s}" for q, s in pairs if q == p))]
    targets = ["power", *[f"power_target_{h}" for h in horizons]] if horizons else []
    return rows.withColumns(calendar_columns()).select("farm_no", "ts", *features, *calendar_columns(), *targets)


def is_feature_column(name: str) -> bool:
    return name not in META_COLUMNS and not any(m in name for m in MARKERS)


def select_feature_columns(df: DataFrame) -> list[str]:
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [n for n, t in df.dtypes if t in numeric and is_feature_column(n)]


def training_frame(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows complete in every feature and in the target."""
    return df.dropna(subset=[*features, target])


def filled_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scoring-time frame: a missing feature counts as 0."""
    return df.withColumns({f: F.coalesce(F.col(f), F.lit(0.0)) for f in features})


def column_means(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Mean of every column over all rows, 0 for a column without values; one row of doubles comes to the driver."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    means = np.array([0.0 if v is None else v for v in row], dtype=float)
    return np.where(np.isfinite(means), means, 0.0)


def univariate_scores(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, n, r, f_score) of a one-feature linear regression, per key.

    Each task reduces its rows to five sums per key and feature, taken around the overall means, so hundreds of features
    cost no wide aggregate and a small spread around a large mean is kept. A feature constant within a key has null scores.
    """
    names, by = list(features), list(keys)
    rows = training_frame(df, names, target).select(*by, *[F.col(c).cast("double").alias(c) for c in (*names, target)])
    middle = column_means(rows, [*names, target])
    parts_of = ["n", "x", "xx", "xy", "y", "yy"]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, part in batch.groupby(by, sort=False, dropna=False) if by else [((), batch)]:
                values = part[[*names, target]].to_numpy() - middle
                x, y = values[:, :-1], values[:, -1]
                sums = np.column_stack([
                    np.full(len(names), float(len(y))), x.sum(axis=0), (x * x).sum(axis=0), x.T @ y,
                    np.full(len(names), y.sum()), np.full(len(names), y @ y)])
                out.append(pd.DataFrame(sums, columns=parts_of).assign(
                    feature=names, **dict(zip(by, key, strict=True)))[[*by, *parts_of, "feature"]])
            if out:
                yield pd.concat(out)

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in by], *[f"{c} double" for c in parts_of], "feature string"])
    total = rows.mapInPandas(partial, schema).groupBy(*by, "feature").agg(*[F.sum(c).alias(c) for c in parts_of])
    n, x, xx, xy, y, yy = (F.col(c) for c in parts_of)
    x_var, y_var = xx - x * x / n, yy - y * y / n
    r = F.when((x_var > xx * 1e-12) & (y_var > yy * 1e-12), (xy - x * y / n) / F.sqrt(x_var * y_var))
    scored = total.where(n > 2).select(*by, "feature", n.cast("long").alias("n"), r.alias("r"))
    return scored.withColumn(
        "f_score", F.try_divide(F.col("r") * F.col("r"), 1 - F.col("r") * F.col("r")) * (F.col("n") - 2))


def top_features(df: DataFrame, features: Sequence[str], target: str, k: int) -> list[str]:
    """Names of the k best features; the list, not the data, comes to the driver."""
    best = univariate_scores(df, features, target).orderBy(F.desc_nulls_last("f_score"), "feature").limit(k)
    return [row.feature for row in best.collect()]


def scale_parameters(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per feature, from the training rows given."""
    wide = df.agg(F.struct(*[
        F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")).alias(f) for f in features
    ]).alias("s"))
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"s.{f}.mean"), F.col(f"s.{f}.std")) for f in features
    ])).alias("p")).select("p.*")


def scale(df: DataFrame, train: DataFrame, features: Sequence[str],
          keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Standardise with statistics of `train` per key; a constant feature keeps scale 1.

    A key absent from `train` has null features.
    """
    stats = train.groupBy(*keys).agg(
        *[F.avg(f).alias(f"_{f}_m") for f in features], *[F.stddev_pop(f).alias(f"_{f}_s") for f in features])
    joined = attach(df, stats, keys, "left")
    return joined.select(*[
        ((F.col(c) - F.col(f"_{c}_m")) / F.when(F.col(f"_{c}_s") > 0, F.col(f"_{c}_s")).otherwise(F.lit(1.0))).alias(c)
        if c in features else F.col(c) for c in df.columns])


def add_weather(df: DataFrame, weather: DataFrame, lead_minutes: int) -> DataFrame:
    """Attach the forecast valid `lead_minutes` after each issue row; nulls when there is none."""
    fields = ["wind_speed", "wind_direction", "temperature"]
    chosen = weather.where(F.col("lead_minutes") == lead_minutes)
    unique = chosen.groupBy("timestamp").agg(
        F.min_by(F.struct(*fields), F.struct(*fields)).alias("_w")
    ).select(
        F.col("timestamp").alias("ts"), *[F.col("_w")[f].alias(f"nwp_{f}") for f in fields]
    )
    return df.join(unique, "ts", "left")
