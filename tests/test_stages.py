"""Stage tables hold what their readers need, and no more."""

from pyspark.sql import functions as F

from gustline.operators import boosting as X
from gustline.operators import cleaning as C
from gustline.operators import features as E
from gustline.plans import q_boost, q_features, q_models, q_scores, stages
from gustline.plans.q_clean import clean_frame
from gustline.settings import FARM_SERIES
from gustline.sources.derived import DERIVED

SF = "/root/testdata/sf0.001"


def test_scores_store_test_rows_once_per_slot(spark, monkeypatch):
    """Scores of the test rows don't write forecasts of all rows, and targets are stored by slot, not by slot and horizon."""
    monkeypatch.setattr(stages, "_PATHS", {})
    q_scores.metrics(spark, SF)
    stored = {key[2]: spark.read.schema(schema).parquet(path) for key, (path, schema) in stages._PATHS.items()}
    assert "predictions" not in stored
    assert [r.split for r in stored["test_predictions"].select("split").distinct().collect()] == ["test"]
    assert "horizon" not in stored["targets"].columns
    long = q_features.series_targets(spark, SF)
    assert long.count() == 5 * stored["targets"].count()
    assert long.dtypes == q_features.build_targets(spark, SF).dtypes
    whole = q_scores.predictions(spark, SF).where("split = 'test'").agg(F.count("*"), F.round(F.sum("y_pred"), 3)).first()
    assert whole == stored["test_predictions"].agg(F.count("*"), F.round(F.sum("y_pred"), 3)).first()


def test_grid_search_reads_features_of_the_farm_only(spark, monkeypatch):
    monkeypatch.setattr(stages, "_PATHS", {})
    farm = q_boost.farm_series_rows(spark, SF)
    assert "series_features" not in {key[2] for key in stages._PATHS}
    assert [r.series_id for r in farm.select("series_id").distinct().collect()] == [FARM_SERIES]
    same = q_boost.series_rows(spark, SF).where(f"series_id = '{FARM_SERIES}'")
    assert farm.columns == same.columns and farm.exceptAll(same).count() == 0 and same.count() == farm.count()


def test_wide_rows_are_not_shuffled_by_slot(spark):
    """The farm means are broadcast from the first plan on, whichever side is ready first."""
    df = clean_frame(spark, SF)
    matrix = E.feature_matrix(df, C.farm_frame(df), DERIVED)
    plan = matrix._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scores_of_one_learner_grow_no_other(spark, monkeypatch):
    small = {m: X.Boost(2, 2, average=p.average) for m, p in X.LEARNERS.items()}
    monkeypatch.setattr(X, "LEARNERS", small)
    monkeypatch.setattr(stages, "_PATHS", {})
    monkeypatch.setattr(stages, "_VALUES", {})
    grown, fit = [], X.fit
    monkeypatch.setattr(X, "fit", lambda blocks, chains: grown.append(sorted({c.model for c in chains})) or fit(blocks, chains))
    one = q_boost.tested(spark, SF, "gbt_b")
    assert grown == [["gbt_b"]]
    every = q_boost.validated(spark, SF)
    assert grown == [["gbt_b"], ["gbt_a", "random_forest"]]
    assert {r.model for r in every.select("model").distinct().collect()} == set(small) and every.count() == 3 * one.count()
    chains, models, *_ = q_boost.learned(spark, SF)
    assert len(grown) == 2 and [r.chain for r in models.select("chain").distinct().orderBy("chain").collect()] == list(range(len(chains)))


def test_scores_of_all_places_store_no_wide_rows(spark, monkeypatch):
    monkeypatch.setattr(stages, "_PATHS", {})
    monkeypatch.setattr(stages, "_VALUES", {})
    scores = q_models.e13_wide(spark, SF)
    assert "wide_features" not in {key[2] for key in stages._PATHS} and scores.count() > 0
    held = q_models.wide_frame(spark, SF, train=True).where("split = 'train'")
    whole = q_models.wide_rows(spark, SF).where("split = 'train'")
    assert held.columns == whole.columns and held.count() == whole.count() > 0
    assert held.exceptAll(whole).count() == 0


def test_no_events_give_no_scores_of_places(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert q_models.e13_wide(spark, str(tmp_path)).collect() == [] and q_models.e13_places(spark, str(tmp_path)).collect() == []
