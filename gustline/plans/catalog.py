"""Imports every query module so that the registry is complete, and holds the flagship query."""

from pyspark.sql import functions as F

from gustline.functions.timeline import over_slots
from gustline.operators import cleaning as C
from gustline.operators import scoring as I
from gustline.operators import splits as S
from gustline.plans import q_alerts, q_boost, q_clean, q_features, q_models, q_scores, q_sources  # noqa: F401
from gustline.plans.registry import ORACLE, QUERIES, query  # noqa: F401
from gustline.sources.derived import DERIVED, readings, stamps


@query("m0_persistence_rmse", """
SELECT series_id, round(sqrt(avg((power - y_true) ** 2)), 4) AS rmse, round(avg(abs(power - y_true)), 4) AS mae, count(*) AS n_samples
FROM t_target WHERE horizon = '10min' AND split = 'test' AND is_observed = 1 AND is_imputed = 0 AND is_simulated = 0
  AND power IS NOT NULL AND y_true IS NOT NULL AND series_id <> 'farm_total_power' GROUP BY series_id""")
def persistence_rmse(spark, sf):
    """Dedupe, clip, grid, fill, one-step target, split, official mask and metrics, all in one plan.

    The fill and the target share one pass over the grid.
    """
    seen = stamps(spark, sf)
    grid, cutoff = C.cleaned_grid(readings(spark, sf), DERIVED, stamps=seen, unique=True)
    rows = over_slots(
        grid.withColumnRenamed("turbine_id", "series_id"), ["series_id"], DERIVED.interval_minutes,
        DERIVED.max_fill_slots, 1, [C.fill_stage(DERIVED), lambda w: {"y_true": F.lead("power", 1).over(w)}])
    flagged = C.flag_simulated(rows, cutoff)
    split = S.split_by_time(flagged, C.time_bounds(seen, DERIVED), DERIVED).withColumns(
        {"y_pred": F.col("power"), "rated": F.lit(DERIVED.rated_kw)})
    scored = I.metrics(I.official_rows(split), ["series_id"])
    return scored.select("series_id", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), "n_samples")
