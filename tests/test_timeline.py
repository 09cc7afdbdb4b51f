"""Chunked windows, runs and neighbours against plain scans."""

import random

import pytest
from conftest import stamp
from pyspark.sql import Window
from pyspark.sql import functions as F

from gustline.functions.quantiles import exact_quantiles
from gustline.functions.timeline import over_slots, regular_slots, run_positions, slot_of, slot_start, with_previous


@pytest.fixture
def series(spark):
    rng = random.Random(7)
    rows = [(f"TB0{t}", stamp(i), None if rng.random() < 0.2 else float(rng.randrange(0, 40)))
            for t in (1, 2) for i in range(300)]
    return spark.createDataFrame(rows, "turbine_id string, ts timestamp_ntz, power double")


@pytest.mark.parametrize("span", [40, 64, 5000])
def test_chunked_windows_equal_whole_series_windows(series, span):
    def columns(w):
        return {
            "back": F.lag("power", 9).over(w), "ahead": F.lead("power", 5).over(w),
            "mean": F.avg("power").over(w.rowsBetween(-9, -1)),
            "filled": F.last("power", ignorenulls=True).over(w.rowsBetween(-4, 0))}

    chunked = over_slots(series, ["turbine_id"], 10, 9, 5, columns, span=span)
    whole = series.select("*", *[c.alias(n) for n, c in columns(Window.partitionBy("turbine_id").orderBy("ts")).items()])
    assert chunked.count() == 600
    assert chunked.exceptAll(whole).count() == 0


def test_windows_take_the_wanted_number_of_tasks(series):
    """Rows that are small when they are shuffled still go to as many tasks as asked for, with the same windows."""
    def columns(w):
        return {"back": F.lag("power", 9).over(w)}

    few, many = (over_slots(series, ["turbine_id"], 10, 9, 5, columns, span=40, tasks=n) for n in (None, 12))
    assert few.rdd.getNumPartitions() < 12 == many.rdd.getNumPartitions()
    assert many.exceptAll(few).count() == 0 and many.count() == 600


def test_slot_round_trip(spark):
    df = spark.createDataFrame([(stamp(i),) for i in range(500)], "ts timestamp_ntz")
    assert df.where(slot_start(slot_of(F.col("ts"), 10), 10) != F.col("ts")).count() == 0


def test_regular_slots_fill_every_chunk(spark):
    turbines = spark.createDataFrame([("a",), ("b",)], "turbine_id string")
    grid = regular_slots(turbines, F.lit(95).cast("long"), F.lit(1203).cast("long"), 10, span=100)
    assert grid.count() == 2 * (1203 - 95 + 1)
    assert grid.distinct().count() == grid.count()


@pytest.mark.parametrize("span", [7, 50, 5000])
def test_run_positions_carry_over_chunks(series, span):
    got = {(r.turbine_id, r.ts): r.n for r in run_positions(
        series, ["turbine_id"], 10, F.col("power") < 25, "n", span=span).collect()}
    for turbine in ("TB01", "TB02"):
        count = 0
        for r in series.where(F.col("turbine_id") == turbine).orderBy("ts").collect():
            count = count + 1 if r.power is not None and r.power < 25 else 0
            assert got[(turbine, r.ts)] == count


def test_previous_reaches_over_empty_spans(spark):
    at = [0, 1, 5, 3000, 3001, 9000]
    df = spark.createDataFrame([("a", stamp(i)) for i in at], "turbine_id string, ts timestamp_ntz")
    got = {r.ts: r.previous for r in with_previous(df, ["turbine_id"], days=3).collect()}
    for earlier, later in zip(at, at[1:], strict=False):
        assert got[stamp(later)] == stamp(earlier)
    assert got[stamp(0)] is None


def test_exact_quantiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    groups = {"hot": np.r_[np.zeros(4000), rng.normal(0, 300, 1000)], "small": rng.normal(5, 2, 11), "one": np.array([4.5])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.05, 0.5, 0.9, 0.99, 1.0]
    for r in exact_quantiles(df, ["k"], "v", probs).collect():
        assert r.quantile == pytest.approx(np.quantile(groups[r.k], r.prob), abs=1e-9)
        assert r.n == len(groups[r.k])
    pooled = np.concatenate(list(groups.values()))
    for r in exact_quantiles(df, [], "v", probs).collect():
        assert r.quantile == pytest.approx(np.quantile(pooled, r.prob), abs=1e-9)


def test_exact_quantiles_of_small_values_in_one_hot_group(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    groups = {"hot": rng.uniform(-0.0099, 0.0099, 9000), "other": rng.uniform(0, 1e-6, 1000)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    got = exact_quantiles(df, ["k"], "v", [0.0, 0.05, 0.5, 0.95, 1.0]).collect()
    assert len(got) == 10
    for r in got:
        assert r.quantile == pytest.approx(np.quantile(groups[r.k], r.prob), abs=1e-15)


def test_exact_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([("a", None)], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", [0.5]).collect() == []
