"""Fill, grid, flags and the no-lookahead facts of a monotonic series."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import stamp
from pyspark.sql import functions as F

from gustline.functions.timeline import over_slots
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.operators import splits as S
from gustline.settings import FarmSettings

SETTINGS = FarmSettings(report_date="2024-01-01 00:40:00")


def values(df, column):
    return [r[column] for r in df.orderBy("ts").collect()]


def test_first_reading_keeps_the_earliest_even_when_null(spark):
    rows = [("a", 1, 2, 5.0), ("a", 1, 1, None), ("a", 1, 3, 7.0), ("b", 1, 9, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, o int, v double")
    got = {(r.k, r.o): r.v for r in C.first_reading(df, ["k", "t"], ["o"]).collect()}
    assert got == {("a", 1): None, ("b", 9): 1.0}


def test_clip(scada):
    df = C.clip_readings(scada(power=[-100.0, 500.0, 3000.0, None], wind_speed=[-5.0, 10.0, 70.0, None]))
    assert values(df, "power") == [0.0, 500.0, 2200.0, None]
    assert values(df, "wind_speed") == [0.0, 10.0, 60.0, None]


def test_fill_small_gaps(scada):
    power = [100.0, None, None, 400.0, 500.0, None, 700.0, 800.0, 900.0, 1000.0]
    got = values(C.fill_forward(scada(power=power)), "power")
    assert got[1] == got[2] == 100.0 and got[5] == 500.0


def test_fill_stops_after_the_limit(scada):
    df = C.fill_forward(scada(power=[100.0] + [None] * 13 + [5.0]))
    power, flags = values(df, "power"), values(df, "is_imputed")
    assert power[12] == 100.0 and power[13] is None
    assert flags[1:13] == [1] * 12 and flags[13] == 0


def test_provenance_after_the_grid(scada):
    full = [1.0] * 8
    df = scada(power=full, wind_speed=full, temperature=full, frequency=[50.0] * 8, skip=(2, 3))
    out = C.clean(df.withColumn("reading_no", F.lit(0)), SETTINGS)
    facts = out.agg(F.count("*"), F.sum("is_observed"), F.sum("is_synthetic"), F.sum("is_imputed"), F.sum("is_simulated")).first()
    assert tuple(facts) == (8, 6, 2, 2, 4)


def test_grid_and_fill_are_idempotent(scada):
    df = scada(power=[float(i) for i in range(50)], wind_speed=[1.0] * 50, temperature=[1.0] * 50,
               frequency=[50.0] * 50, skip=(4, 5, 20))
    once = C.fill_forward(C.to_regular_grid(df, SETTINGS), SETTINGS).select(*df.columns)
    twice = C.fill_forward(C.to_regular_grid(once, SETTINGS), SETTINGS).select(*df.columns)
    assert once.exceptAll(twice).count() == 0 and twice.count() == 50


def test_farm_total_of_an_empty_slot(scada):
    df = scada(power=[None, 5.0])
    assert values(C.farm_frame(df), "farm_total_power") == [None, 5.0]
    assert values(C.farm_frame(df, skipna_zero=True), "farm_total_power") == [0.0, 5.0]


@pytest.fixture
def monotonic(scada):
    n = 500
    return scada(power=[10.0 * i for i in range(n)], wind_speed=[0.5 * i for i in range(n)],
                 temperature=[25 + 3 * math.sin(0.1 * i) for i in range(n)])


def test_features_look_back_only(monotonic):
    out = E.window_features(monotonic).orderBy("ts").collect()
    for i in (150, 300, 499):
        for k in (1, 2, 3, 6, 12, 144):
            assert out[i][f"power_lag{k}"] == 10.0 * (i - k)
        assert out[i]["power_roll6_mean"] == sum(10.0 * j for j in range(i - 6, i)) / 6
        assert out[i]["power_diff1"] == 10.0
    assert out[6]["power_roll6_mean"] == 25.0
    assert out[0]["power_ramp"] is None and out[0]["power_lag1"] is None
    assert out[10]["power_target_10min"] == 110.0 and out[499]["power_target_10min"] is None


def test_features_do_not_change_when_the_future_does(monotonic):
    features = [c for c in E.window_features(monotonic).columns if "_target_" not in c]
    changed = monotonic.withColumn("power", F.when(F.col("ts") > stamp(300), -1.0).otherwise(F.col("power")))
    before = E.window_features(monotonic).where(F.col("ts") <= stamp(300)).select(*features)
    after = E.window_features(changed).where(F.col("ts") <= stamp(300)).select(*features)
    assert before.exceptAll(after).count() == 0


def test_rolling_equals_pandas(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(900) < 0.3, np.nan, rng.normal(500, 200, 900))
    df = spark.createDataFrame([("a", stamp(i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)],
                               "turbine_id string, ts timestamp_ntz, power double")
    got = over_slots(df, ["turbine_id"], 10, 144, 0, E.rolling_stages(["power"], (6, 18, 36, 144)), span=400).orderBy(
        "ts").toPandas()
    for w in (6, 18, 36, 144):
        roller = pd.Series(x).shift(1).rolling(w, min_periods=1)
        for name, want in (("mean", roller.mean()), ("std", roller.std()), ("min", roller.min()), ("max", roller.max())):
            np.testing.assert_allclose(got[f"power_roll{w}_{name}"].to_numpy(dtype=float), want, rtol=1e-9, atol=1e-7)


def test_fill_and_features_in_one_pass_equal_two(scada):
    import random

    rng = random.Random(9)

    def draw():
        return [None if rng.random() < 0.6 else float(rng.randrange(0, 2000)) for _ in range(900)]

    grid = C.to_regular_grid(scada(power=draw(), wind_speed=draw(), temperature=draw(), frequency=draw()))
    apart = E.window_features(C.fill_forward(grid), span=700)
    together = E.window_features(grid, fill=True, span=450)
    columns = [c for c in apart.columns if not c.endswith(("_std", "_mean"))]
    assert apart.count() == 900
    assert apart.select(columns).exceptAll(together.select(columns)).count() == 0


def test_growth_from_zero(scada):
    df = over_slots(scada(power=[0.0, 5.0, 10.0, 0.0, 0.0]), ["turbine_id"], 10, 6, 0,
                    lambda w: E.change_columns(w, ["power"]))
    assert values(df, "power_pctchange1") == [None, 0.0, 1.0, -1.0, None]


def test_feature_names():
    assert E.is_feature_column("power_lag1")
    for name in ("power_target_1hour", "power_missing", "ts", "is_imputed", "x_is_anomaly"):
        assert not E.is_feature_column(name)


def test_split_positions_equal_a_global_order(monotonic):
    bounds = C.time_bounds(monotonic)
    by_grid = S.split_by_time(monotonic, bounds).select("ts", "split")
    by_rows = S.split_by_rows(monotonic).select("ts", "split")
    assert by_grid.exceptAll(by_rows).count() == 0
    assert {r.split: r["count"] for r in by_grid.groupBy("split").count().collect()} == {
        "train": 350, "validation": 75, "test": 75}


def test_walk_forward_makes_all_five_folds(spark, scada):
    df = scada(power=[1.0] * 1000)
    rows = S.walk_forward(df, C.time_bounds(df)).groupBy("fold", "part").agg(F.count("*").alias("n")).collect()
    sizes = {(r.fold, r.part): r.n for r in rows}
    assert {f for f, _ in sizes} == {1, 2, 3, 4, 5}
    assert sizes[(1, "train")] == 250 and sizes[(1, "validation")] == 120 and sizes[(5, "test")] == 120


def test_places_meet_before_they_are_widened(spark):
    from gustline.operators import features as E

    rows = spark.createDataFrame([(0, p, f"t{p}", stamp(i), float(i), 1.0, 2.0) for p in ("TB01", "TB02") for i in range(4)],
                                 "farm_no long, place string, turbine_id string, ts timestamp_ntz, power double, wind_speed double, temperature double")
    wide = E.farm_scope_matrix(rows, ["TB01", "TB02"])
    assert [(r.TB01_power, r.TB02_power) for r in wide.orderBy("ts").collect()] == [(float(i), float(i)) for i in range(4)]
    lines = wide._jdf.queryExecution().optimizedPlan().toString(), wide._jdf.queryExecution().sparkPlan().toString()
    plan = wide._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not [a for a, b in zip(plan, plan[1:]) if "Exchange" in a and "pivotfirst" in b]


def test_windows_of_all_places_equal_those_of_each(spark):
    """Windows over the places of a farm give the features of every turbine alone, also where a place starts later, ends earlier or is absent."""
    from gustline.operators import features as E

    spans = {(0, "TB01"): (0, 400), (0, "TB02"): (30, 400), (0, "TB03"): (0, 250), (1, "TB01"): (0, 400), (1, "TB02"): (0, 90)}
    rows = spark.createDataFrame(
        [(farm, p, f"{p}-{farm}", stamp(i), None if i % 17 == 5 else float(i * i % 41), float(i % 13), float(i % 7) - 2.0)
         for (farm, p), (low, high) in spans.items() for i in range(low, high)],
        "farm_no long, place string, turbine_id string, ts timestamp_ntz, power double, wind_speed double, temperature double")
    wide = E.farm_scope_matrix(rows, ["TB01", "TB02", "TB03"], horizons={"1hour": 6})
    found = {(r.farm_no, r.ts): r for r in wide.collect()}
    assert len(found) == 800
    alone = E.window_features(rows, sensors=("power", "wind_speed", "temperature"), horizons={})
    names = [c for c in alone.columns if c.startswith(("power", "wind_speed", "temperature"))]
    places = ("TB01", "TB02", "TB03")
    assert wide.columns == [  # tree learners draw features by their place in this list
        "farm_no", "ts", *[f"{p}_{c}" for p in places for c in names if c.startswith("power")],
        *[f"{p}_{c}" for p in places for c in names if not c.startswith("power")], *E.calendar_columns(), "power", "power_target_1hour"]
    cells = 0
    for r in alone.collect():
        for c in names:
            assert found[r.farm_no, r.ts][f"{r.place}_{c}"] == r[c], (r.place, c)
            cells += r[c] is not None
    assert cells == sum(v is not None for r in found.values() for c, v in r.asDict().items() if c.startswith("TB"))
    total = {k: sum(v for v in (r.TB01_power, r.TB02_power, r.TB03_power) if v is not None) for k, r in found.items()}
    for (farm, ts), r in found.items():
        assert (r.power or 0.0) == total[farm, ts] and (r.power_target_1hour or 0.0) == total.get((farm, ts + (stamp(6) - stamp(0))), 0.0)


def test_features_of_a_farm_are_not_shuffled(spark):
    """Readings meet in the one shuffle; before, the features of every place were shuffled to meet and again to be joined."""
    from gustline.operators import features as E

    rows = spark.createDataFrame([], "farm_no long, place string, turbine_id string, ts timestamp_ntz, power double, wind_speed double, temperature double")
    wide = E.farm_scope_matrix(rows, ["TB01", "TB02"])
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
