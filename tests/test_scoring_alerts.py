"""Masks, metrics, bias, screening rules, frozen runs and model fits."""

import random

import numpy as np
import pytest
from conftest import stamp
from pyspark.sql import functions as F

from gustline.operators import alerts as J
from gustline.operators import audits as K
from gustline.operators import diagnostics as D
from gustline.operators import features as E
from gustline.operators import models as G
from gustline.operators import quality as Q
from gustline.operators import scoring as I
from gustline.settings import FarmSettings

PREDICTIONS = ("series_id string, ts timestamp_ntz, horizon string, model string, split string, y_true double, "
               "y_pred double, rated double, is_observed int, is_imputed int, is_simulated int")


def predictions(spark, truth, guess, series="TB01", model="m", split="test", rated=2200.0, horizon="10min"):
    return spark.createDataFrame(
        [(series, stamp(i), horizon, model, split, y, p, rated, 1, 0, 0) for i, (y, p) in enumerate(zip(truth, guess, strict=True))],
        PREDICTIONS)


def test_error_relative_to_rated_power(spark):
    rows = predictions(spark, [100.0, 200.0, 300.0], [110.0, 210.0, 290.0])
    assert I.metrics(rows).first().nmae_pct == pytest.approx(10 / 2200 * 100)
    assert I.metrics(rows.withColumn("rated", F.lit(26400.0))).first().nmae_pct == pytest.approx(10 / 26400 * 100)


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(900, 300, 400), rng.normal(900, 300, 400)
    m = I.metrics(predictions(spark, y.tolist(), p.tolist())).first()
    assert m.rmse == pytest.approx(np.sqrt(np.mean((p - y) ** 2)))
    assert m.bias == pytest.approx(np.mean(p - y))
    assert m.r2 == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))
    assert m.max_error == pytest.approx(np.max(np.abs(p - y)))


def test_skill_against_a_baseline(spark):
    truth = [100.0 * i for i in range(1, 9)]
    rows = predictions(spark, truth, [t + 2 for t in truth]).unionByName(
        predictions(spark, truth, [t + 4 for t in truth], model="persistence"))
    got = {r.model: r.skill_vs_persistence for r in I.skills(rows).collect()}
    assert got == {"m": pytest.approx(0.5), "persistence": pytest.approx(0.0)}


def test_official_mask(spark):
    flags = [(1, 0, 1, 1), (0, 0, 1, 1), (1, 0, 1, 1), (1, 1, 1, 1), (1, 0, 1, 1), (1, 0, 0, 1)]
    df = spark.createDataFrame([(stamp(i), *f) for i, f in enumerate(flags)],
                               "ts timestamp_ntz, observed_target int, target_imputed int, prediction_available int, feature_available int")
    df = df.withColumn("official_cutoff", F.lit("2025-01-01").cast("timestamp_ntz"))
    assert [r.k for r in df.withColumn("k", I.official_mask()).orderBy("ts").collect()] == [True, False, True, False, True, False]


def test_mask_columns_derived_from_flags(spark):
    rows = [(stamp(0), 1, 0, 0), (stamp(1), 1, 1, 0), (stamp(2), 0, 0, 0), (stamp(3), 1, 0, 1)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, is_observed int, is_imputed int, is_simulated int")
    for cutoff in (None, F.lit(stamp(3)).cast("timestamp_ntz")):
        out = I.official_columns(df, cutoff).withColumn("k", I.official_mask()).orderBy("ts").collect()
        assert [r.k for r in out] == [True, False, False, False]


def test_bias_fit_recovers_the_line(spark):
    guess = [100.0 * i for i in range(80)]
    rows = predictions(spark, [1.2 * p + 500 for p in guess], guess, series="farm_total_power", split="validation")
    fit = I.fit_bias(rows).first()
    assert fit.slope == pytest.approx(1.2) and fit.intercept == pytest.approx(500) and fit.val_mae_corrected == pytest.approx(0, abs=1e-6)


def test_horizon_windows_use_common_rows(spark):
    y = [float(1000 + 300 * np.sin(i / 3)) for i in range(60)]
    a = predictions(spark, y, [v + 5 for v in y], series="farm_total_power", horizon="6hour")
    late = [v if i < 36 else None for i, v in enumerate(y)]
    b = predictions(spark, late, [v + 9 for v in y], series="farm_total_power", horizon="24hour")
    got = {(r.horizon_a, r.horizon_b): r for r in I.horizon_windows(a.unionByName(b), "m", ["6hour", "24hour"]).collect()}
    assert got[("6hour", "24hour")].n_common_samples == 36
    assert got[("6hour", "24hour")].window_identical and not got[("24hour", "6hour")].window_identical


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) * [1, 50, 0.1] + [5, -100, 3]
    y = x @ [2.0, 0.3, -7.0] + rng.normal(size=200)
    df = spark.createDataFrame([("s", "h", *map(float, r), float(v)) for r, v in zip(x, y, strict=True)],
                               "series_id string, horizon string, a double, b double, c double, y_true double")
    fit = G.fit_linear(df, ["a", "b", "c"], alpha=10.0).first()
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean())) / x.std(0)
    np.testing.assert_allclose(fit.coefs, w, rtol=1e-8)
    assert fit.intercept == pytest.approx(y.mean() - w @ x.mean(0))
    some = G.solve_blocks(G.products(df, ["a", "b", "c"]), ["a", "b", "c"], {"two": {"h": ["c", "a"]}}, 10.0).first()
    own = G.fit_linear(df, ["c", "a"], alpha=10.0).first()
    np.testing.assert_allclose(some.coefs, [own.coefs[1], 0.0, own.coefs[0]], rtol=1e-8)


def test_small_spread_around_a_large_mean_is_kept(spark):
    rng = np.random.default_rng(5)
    x = 1e8 + rng.normal(size=500) * 0.5
    y = 3.0 * (x - 1e8) + rng.normal(size=500) * 0.01
    df = spark.createDataFrame([("s", "h", float(a), float(b)) for a, b in zip(x, y, strict=True)],
                               "series_id string, horizon string, a double, y_true double").repartition(5)
    assert G.fit_linear(df, ["a"]).first().coefs[0] == pytest.approx(np.polyfit(x - x.mean(), y, 1)[0], rel=1e-6)
    assert E.univariate_scores(df, ["a"], "y_true", ["series_id"]).first().r == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-6)


def test_wide_targets_give_the_fits_of_long_ones(spark):
    rng = np.random.default_rng(6)
    rows = [(f"s{i % 2}", *map(float, rng.normal(size=4)), "train" if i % 3 else "test") for i in range(300)]
    rows += [("s0", 1.0, 2.0, 3.0, None, "train"), ("s1", 1.0, None, 3.0, 4.0, "test")]
    wide = spark.createDataFrame(rows, "series_id string, a double, b double, t1 double, t2 double, split string")
    long = wide.selectExpr("series_id", "a", "b", "split", "stack(2, 'x', t1, 'y', t2) as (horizon, y_true)")
    blocks = {"both": ["a", "b"], "own": {"x": ["a"], "y": ["b"]}}
    got = G.compare_linear(wide, blocks, targets={"x": "t1", "y": "t2"}).toPandas()
    want = G.compare_linear(long, blocks).toPandas()
    order = ["series_id", "horizon", "feature_set"]
    got, want = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    assert len(got) == 8 and (got.n_samples == want.n_samples).all()
    np.testing.assert_allclose(got[["mae", "rmse", "r2"]], want[["mae", "rmse", "r2"]], rtol=1e-8)


def test_refit_uses_the_best_preset(spark):
    records = spark.createDataFrame(
        [(0, "b", 2, 1, 0.1, 1, 5.0, 9), (0, "b", 2, 1, 0.1, 2, 3.0, 9), (1, "b", 3, 1, 0.1, 1, 2.0, 9)],
        "candidate int, kind string, trees int, depth int, step double, fold int, rmse double, n_samples long")
    summary = G.grid_summary(records)
    assert {r.candidate: (r.mean_rmse, r.is_best) for r in summary.collect()} == {0: (4.0, False), 1: (2.0, True)}
    rows = spark.createDataFrame([(float(i), float(i), p) for i in range(30) for p in ("train", "validation", "test")],
                                 "x double, y_true double, split string")
    grid = [G.TreePreset("boosted", t, 1, {"stepSize": 0.1}) for t in (2, 3)]
    assert G.refit_best(rows, ["x"], grid, summary).stages[-1].getNumTrees == 3


def test_planted_target_fails_the_audits(spark):
    rows = spark.createDataFrame([("s", "1hour", "m", "s_target_1hour", ["power", "s_target_1hour"])],
                                 "series_id string, horizon string, model string, target string, features array<string>")
    assert K.name_audit(rows).first().status == "FAIL"
    found = K.feature_evidence(rows).first()
    assert found.target_in_features and found.any_future_target


def greedy_frozen(values, length=5):
    blocks = samples = i = 0
    while i < len(values) - length:
        if values[i] is None:
            i += 1
            continue
        j = i + 1
        while j < len(values) and values[j] is not None and abs(values[j] - values[i]) < 1.0:
            j += 1
        if j - i >= length:
            blocks, samples = blocks + 1, samples + j - i
        i = j
    return blocks, samples


def test_frozen_runs_equal_a_greedy_scan(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for t in range(40):
        level, series = 10.0, []
        for _ in range(rng.randrange(6, 160)):
            level += rng.choice([0, 0, 0, 0.25, -0.25, 0.75, -0.75, 3])
            series.append(None if rng.random() < 0.04 else level)
        name = f"T{t:02d}"
        want[name] = greedy_frozen(series)
        rows += [(name, stamp(i), v) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "turbine_id string, ts timestamp_ntz, power double")
    got = {r.turbine_id: (r.frozen_blocks, r.frozen_samples) for r in D.frozen_runs(df).collect()}
    assert got == want


def test_failure_risk_skips_missing_readings(scada):
    power = [1500.0] * 120 + [1.0, None, 2.0, 3.0, None, 4.0, 5.0, 900.0, 1.0]
    got = J.failure_risk(scada(power=power)).orderBy("ts").collect()
    assert [r.stop_count for r in got] == [4, 5]
    assert got[0].stop_risk_score == pytest.approx(0.5)


def test_sustained_heat_fires_once(scada):
    temps = [39.0, 41.0, 41.0, 41.0, 41.0, None, 42.0, 42.0, 42.0]
    rows = J.temperature_warnings(scada(temperature=temps)).where("warning_type = 'sustained_high_temp'").orderBy("ts").collect()
    assert [r.ts for r in rows] == [stamp(3), stamp(8)]


def test_stop_events(scada):
    power = [0.0, 0.0, 9.0, 0.0, 0.0, 0.0, 9.0, None, 1.0, 1.0, 1.0, 1.0]
    rows = J.stop_events(scada(power=power)).orderBy("ts").collect()
    assert [r.failure_event for r in rows] == [0, 0, 0, 1, 1, 1, 0, 0, 1, 1, 1, 1]
    assert sum(r.event_start for r in rows) == 2


def test_ramp_confusion_rates(spark):
    truth = [100.0, 1200.0, 1500.0] * 4
    rows = predictions(spark, truth, truth)
    r = J.ramp_accuracy(rows.withColumn("power", F.col("y_true")), FarmSettings()).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (11, 0, 0, 1)
    assert r.false_alarm_rate == 0 and r.false_discovery_rate == 0


def test_isolation_forest_finds_outliers_and_is_repeatable(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (3000, 2)))]
    rows += [(10_000 + i, 12.0 + i, -12.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    first = D.isolation_scores(df, ["a", "b"], ["id"], trees=20)
    second = D.isolation_scores(df.repartition(7), ["a", "b"], ["id"], trees=20)
    assert first.exceptAll(second).count() == 0
    assert first.where("id >= 10000 and isolation_anomaly = 1").count() == 5


def test_contract_fails_closed(spark):
    good = spark.createDataFrame([(1, 5)], "rmse int, n_samples int")
    bad = spark.createDataFrame([(1, 0)], "rmse int, n_samples int")
    Q.require_pass(Q.check_contract({"m": good}, {"m": ["rmse"]}))
    for tables, required in (({"m": bad}, {"m": ["rmse"]}), ({"m": good}, {"m": ["mae"]}), ({"m": good}, {"x": ["rmse"]})):
        with pytest.raises(ValueError):
            Q.require_pass(Q.check_contract(tables, required))


@pytest.mark.parametrize("n", [300, 4320])
def test_isolation_trees_have_full_samples(spark, n):
    df = spark.range(n).selectExpr("id", "cast(id % 97 as double) a", "cast(id % 31 as double) b")
    rows = D.isolation_sample(df, ["a", "b"], ["id"], 100, 256, 42).groupBy("tree").count().collect()
    assert len(rows) == 100 and {r["count"] for r in rows} == {min(256, n)}


def test_no_added_slots_give_no_examples(scada):
    whole, gappy = scada(wind_speed=[1.0] * 8), scada(wind_speed=[1.0] * 8, skip=(2, 3))
    none = Q.synthetic_report(whole, whole).first()
    assert (none.n_added, none.ratio, none.examples) == (0, 0.0, None)
    some = Q.synthetic_report(gappy, whole).first()
    assert (some.n_added, some.ratio, some.examples) == (2, 0.25, "2024-01-01 00:20, 2024-01-01 00:30")
