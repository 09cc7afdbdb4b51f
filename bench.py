"""Headline timings: prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES are read from the environment."""

from __future__ import annotations

import json
import os
import time

from gustline.plans.catalog import QUERIES
from gustline.session import build_session

# Stage tables first: later queries read them, so their cost is listed on its own.
HEADLINE = [
    "m0_persistence_rmse", "a2_read_all_first_wins", "c1_check_timestamps", "c7_coverage_audit", "c9_quality_report",
    "d10_clean_chain", "e1_lags", "e2_rolling", "e9_targets", "e10_feature_matrix", "f2_split_statistics",
    "f6_walk_forward", "g1_persistence", "g2_ridge", "g4_random_forest", "g9_walk_forward",
    "g15_block_ablation", "g17_champion_scores", "h3_symmetric_intervals", "h5_daily_power", "i7_evaluate_all",
    "i10_farm_metrics", "i15_coverage", "i16_split_conformal", "i25_residual_histogram", "j2_anomaly_alerts",
    "j4_failure_risk", "j6_residual_anomalies", "j7_isolation_forest", "j13_ramp_accuracy", "j15_frozen_runs",
    "j16_findings", "k3_leakage_assertions",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        begin = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - begin, 3)
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
