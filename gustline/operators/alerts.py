"""Ramp, anomaly, temperature and stop screening, event runs, states and alert accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.functions.timeline import over_slots, run_positions
from gustline.settings import DEFAULTS, FarmSettings

MIN_ROWS = 100
# Fixed values of the screening rules.
RAMP_MW_PER_MIN, RAMP_CERTAIN = 0.1, 0.5
HIGH_WARN, HIGH_CRITICAL, LOW_WARN, LOW_CRITICAL = 45.0, 50.0, -10.0, -15.0
RAPID_CHANGE, SUSTAINED_HIGH = 5.0, 40.0
STOP_KW, STOP_MEAN_KW, STOP_COUNT = 10.0, 500.0, 3
STOPPED_KW, MIN_STOP_SLOTS = 5.0, 3
Z_ALERT, Z_DETECT, Z_RESIDUAL = 2.5, 3.0, 3.0


def screening(df: DataFrame) -> DataFrame:
    """Columns saying that an alert is a flag, not a confirmed event."""
    return df.withColumns({
        "method": F.lit("heuristic_screening"), "confirmed": F.lit(False),
        "verification_status": F.lit("SCREENING_ONLY")})


def ramp_alerts(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Slots whose power moved by more than 0.1 MW per minute since the slot before."""
    step = settings.interval_minutes
    moved = over_slots(
        df.select("turbine_id", "ts", "power"), ["turbine_id"], step, 1, 0,
        lambda w: {"change_mw": (F.col("power") - F.lag("power", 1).over(w)) / 1000})
    rate = F.col("change_mw") / step
    return screening(moved.where(F.abs(rate) > RAMP_MW_PER_MIN).select(
        "turbine_id", "ts",
        F.when(rate > 0, "ramp_up").otherwise("ramp_down").alias("ramp_type"),
        F.col("change_mw").alias("expected_change"),
        F.least(F.lit(1.0), F.abs(rate) / RAMP_CERTAIN).alias("probability"),
        F.lit(RAMP_MW_PER_MIN).alias("threshold")))


def _power_profile(df: DataFrame) -> DataFrame:
    """Rows with both power and wind, with their turbine's mean and spread; at least 100 per turbine."""
    valid = df.where(F.col("power").isNotNull() & F.col("wind_speed").isNotNull())
    stats = valid.groupBy("turbine_id").agg(
        F.avg("power").alias("_mean"), F.stddev_pop("power").alias("_std"), F.count("*").alias("_n"),
    ).where(F.col("_n") >= MIN_ROWS)
    z = F.abs(F.col("power") - F.col("_mean")) / (F.col("_std") + 1e-6)
    return attach(valid, stats, ["turbine_id"]).withColumn("z_score", z)


def anomaly_alerts(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """First matching rule per row: physical limits, wind-power mismatch, then z-score."""
    p, w = F.col("power"), F.col("wind_speed")
    evidence = (
        F.when(p < 0, "Negative power output (possible motoring)")
        .when(p > settings.rated_kw, "Power exceeds rated capacity")
        .when((w < 3) & (p > 500), "High power at low wind speed")
        .when((w > 15) & (p < 200), "Low power at high wind speed")
        .when(F.col("z_score") > Z_ALERT, "Statistical anomaly")
    )
    return screening(_power_profile(df).withColumn("evidence", evidence).where(F.col("evidence").isNotNull()).select(
        "turbine_id", "ts", F.col("z_score").alias("anomaly_score"), "evidence",
        F.lit("power_output").alias("suspected_component")))


def temperature_warnings(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """One row per warning; a reading may give several.

    A sustained warning fires on exactly the third high reading in a row, so three slots of history
    decide it.
    """
    t = F.col("temperature")

    def columns(w):
        high = t >= SUSTAINED_HIGH
        earlier = [F.coalesce(F.lag(high, k).over(w), F.lit(False)) for k in (1, 2, 3)]
        return {
            "_before": F.lag("temperature", 1).over(w),
            "third": high & earlier[0] & earlier[1] & ~earlier[2],
            "change": F.abs(t - F.lag("temperature", 1).over(w)),
        }

    rows = over_slots(
        df.select("turbine_id", "ts", "temperature"), ["turbine_id"], settings.interval_minutes, 3, 0, columns
    ).where(t.isNotNull())

    def warning(kind: str, severity: str) -> Column:
        return F.struct(F.lit(kind).alias("warning_type"), F.lit(severity).alias("severity"))

    fired = F.array_compact(F.array(
        F.when(t >= HIGH_CRITICAL, warning("high_temperature", "critical"))
        .when(t >= HIGH_WARN, warning("high_temperature", "warning")),
        F.when(t <= LOW_CRITICAL, warning("low_temperature", "critical"))
        .when(t <= LOW_WARN, warning("low_temperature", "warning")),
        F.when(F.col("change") >= RAPID_CHANGE, warning("rapid_temp_change", "warning")),
        F.when(F.col("third"), warning("sustained_high_temp", "warning")),
    ))
    return screening(rows.select("turbine_id", "ts", "temperature", F.explode(fired).alias("_w")).select(
        "turbine_id", "ts", "temperature", "_w.*"))


def failure_risk(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Repeated stops: from the fourth consecutive reading below 10 kW of a turbine that usually runs.

    Missing readings neither extend nor end a run.
    """
    valid = df.where(F.col("power").isNotNull()).select("turbine_id", "ts", "power")
    stats = valid.groupBy("turbine_id").agg(F.avg("power").alias("_mean"), F.count("*").alias("_n"))
    running = stats.where((F.col("_n") >= MIN_ROWS) & (F.col("_mean") > STOP_MEAN_KW)).select("turbine_id")
    rows = attach(valid, running, ["turbine_id"])
    counted = run_positions(
        rows, ["turbine_id"], settings.interval_minutes, F.col("power") < STOP_KW, "stop_count")
    return screening(counted.where(F.col("stop_count") > STOP_COUNT).select(
        "turbine_id", "ts", "stop_count",
        F.least(F.lit(0.85), F.lit(0.3) + F.col("stop_count") * 0.05).alias("stop_risk_score"),
        F.lit("general").alias("component"), F.lit("24hour").alias("horizon")))


def screening_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and status text per alert table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("alert_table"), "n_rows", F.lit(True).alias("heuristic"),
            F.lit("SCREENING_ONLY").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def residual_anomalies(df: DataFrame, threshold: float = Z_RESIDUAL) -> DataFrame:
    """Standardised residual of a linear wind-to-power fit per turbine.

    With ten or fewer complete rows the residual is taken from the turbine's mean. A missing wind reading
    is predicted at zero wind.
    """
    both = F.when(F.col("wind_speed").isNotNull() & F.col("power").isNotNull(), F.lit(1))
    fits = df.groupBy("turbine_id").agg(
        F.count(both).alias("_n"), F.regr_slope("power", "wind_speed").alias("_slope"),
        F.regr_intercept("power", "wind_speed").alias("_intercept"), F.avg("power").alias("_mean"))
    expected = F.when(
        F.col("_n") > 10, F.col("_intercept") + F.col("_slope") * F.coalesce("wind_speed", F.lit(0.0))
    ).otherwise(F.col("_mean"))
    rows = attach(df, fits, ["turbine_id"]).select(
        "turbine_id", "ts", "power", "wind_speed", (F.col("power") - expected).alias("residual"))
    spread = rows.groupBy("turbine_id").agg(
        F.avg("residual").alias("_rm"), F.stddev_pop("residual").alias("_rs"))
    scored = F.when(F.col("_rs") > 0, F.abs(F.col("residual") - F.col("_rm")) / F.col("_rs")).otherwise(F.lit(0.0))
    out = attach(rows, spread, ["turbine_id"]).withColumn("anomaly_score", scored)
    flag = F.coalesce((F.col("anomaly_score") > threshold).cast("int"), F.lit(0))
    return out.select("turbine_id", "ts", "power", "wind_speed", "residual", "anomaly_score", flag.alias("is_anomaly"))


def anomaly_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("turbine_id").agg(
        F.sum("is_anomaly").alias("n_anomalies"), (F.avg("is_anomaly") * 100).alias("pct"))


def stop_events(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """Slots inside a run of at least three slots below 5 kW, and where such a run begins.

    Membership is decided by two slots on each side, so runs of any length need no carry-over.
    """
    def lows(w):
        return {"_low": F.coalesce((F.col("power") < STOPPED_KW).cast("int"), F.lit(0))}

    def near(w):
        reach = {k: F.coalesce((F.lag("_low", -k) if k < 0 else F.lead("_low", k)).over(w), F.lit(0))
                 for k in (-2, -1, 1, 2)}
        low = F.col("_low") == 1
        inside = (
            ((reach[-2] + reach[-1]) == 2) | ((reach[-1] + reach[1]) == 2) | ((reach[1] + reach[2]) == 2))
        return {
            "failure_event": (low & inside).cast("int"),
            "event_start": (low & (reach[-1] == 0) & ((reach[1] + reach[2]) == 2)).cast("int"),
        }

    return over_slots(
        df.select("turbine_id", "ts", "power"), ["turbine_id"], settings.interval_minutes, 2, 2, [lows, near])


def stop_summary(events: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    return events.groupBy("turbine_id").agg(
        F.sum("failure_event").alias("failure_slots"), F.sum("event_start").alias("n_events"),
        (F.sum("failure_event") * settings.interval_minutes / 60).alias("failure_hours"))


def operating_state(legacy_states: bool = False) -> Column:
    """State of a row from power, wind and status.

    By default lost communication is a missing wind reading; `legacy_states` asks for the status
    `no_data`, which a clipped frame never carries together with power.
    """
    p, w = F.col("power"), F.col("wind_speed")
    lost = (F.col("status") == "no_data") if legacy_states else w.isNull()
    return (
        F.when(p.isNull(), "missing/unknown").when(p > 5, "generating")
        .when(F.col("status") == "curtailed", "curtailed").when(lost, "communication_loss")
        .when(w > 3, "standby").otherwise("stopped")
    )


def availability(df: DataFrame, settings: FarmSettings = DEFAULTS, legacy_states: bool = False) -> DataFrame:
    """Hours per state, observed and calendar availability and data coverage per turbine."""
    hours = settings.interval_minutes / 60
    state = operating_state(legacy_states)

    def n(name: str) -> Column:
        return F.count_if(state == name)

    observed = n("generating") + n("stopped") + n("curtailed") + n("standby")
    return df.groupBy("turbine_id").agg(
        (F.count("*") * hours).alias("total_hours"),
        *[(n(s) * hours).alias(c) for s, c in (
            ("generating", "generating_hours"), ("stopped", "stopped_hours"), ("curtailed", "curtailed_hours"),
            ("standby", "standby_hours"), ("communication_loss", "comm_loss_hours"),
            ("missing/unknown", "missing_hours"))],
        F.coalesce(F.try_divide(n("generating") * 100, observed), F.lit(0.0)).alias("observed_availability_pct"),
        F.coalesce(F.try_divide(n("generating") * 100, F.count("*")), F.lit(0.0)).alias("calendar_availability_pct"),
        F.coalesce(F.try_divide(observed * 100, F.count("*")), F.lit(0.0)).alias("data_coverage_pct"),
    )


def _confusion(tp: str = "tp", fp: str = "fp", fn: str = "fn", tn: str = "tn") -> dict[str, Column]:
    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in (tp, fp, fn, tn))
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    specificity = share(tn, tn + fp)
    return {
        "precision": precision, "recall": recall, "f1": share(2 * tp, 2 * tp + fp + fn),
        "false_discovery_rate": share(fp, fp + tp), "false_alarm_rate": share(fp, fp + tn),
        "specificity": specificity, "balanced_accuracy": (recall + specificity) / 2,
        "prevalence": share(tp + fn, tp + fp + fn + tn),
    }


def ramp_accuracy(predictions: DataFrame, settings: FarmSettings = DEFAULTS, threshold_pct: float = 0.5,
                  align: str = "target") -> DataFrame:
    """Ramp alarms of each forecast against actual ramps, per (series, horizon, model).

    `align = target` compares the forecast's change with the change of the value it forecasts;
    `align = issue` with the change at the issue slot.
    """
    actual = "y_true" if align == "target" else "power"

    def columns(w):
        def ramp(c: str) -> Column:
            change = F.abs(F.col(c) - F.lag(c, 1).over(w)) / settings.rated_kw * 100
            return F.coalesce(change > threshold_pct, F.lit(False))
        return {"event": ramp(actual), "alarm": ramp("y_pred")}

    rows = over_slots(
        predictions, ["series_id", "horizon", "model"], settings.interval_minutes, 1, 0, columns)
    e, a = F.col("event"), F.col("alarm")
    counts = rows.groupBy("series_id", "horizon", "model").agg(
        F.count_if(e).alias("n_actual_events"), F.count_if(a).alias("n_predicted_events"),
        F.count_if(e & a).alias("tp"), F.count_if(~e & a).alias("fp"),
        F.count_if(e & ~a).alias("fn"), F.count_if(~e & ~a).alias("tn"))
    return counts.withColumns(_confusion()).withColumn("alignment", F.lit(align))


def anomaly_accuracy(df: DataFrame, settings: FarmSettings = DEFAULTS) -> DataFrame:
    """z-score detection against rule-based truth, per turbine; incomplete rows are neither."""
    rated = settings.rated_kw
    valid = F.col("power").isNotNull() & F.col("wind_speed").isNotNull()
    stats = df.where(valid).groupBy("turbine_id").agg(
        F.avg("power").alias("_mean"), F.stddev_pop("power").alias("_std"), F.count("*").alias("_n"),
    ).where(F.col("_n") >= MIN_ROWS)
    p, w = F.col("power"), F.col("wind_speed")
    by_power = valid & ((p < 0) | (p > rated))
    by_wind = valid & ~by_power & (((w < 3) & (p > rated * 0.8)) | ((w > 15) & (p < rated * 0.1)))
    z = F.abs(p - F.col("_mean")) / (F.col("_std") + 1e-6)
    rows = attach(df, stats, ["turbine_id"]).select(
        "turbine_id", F.coalesce(by_power, F.lit(False)).alias("bp"), F.coalesce(by_wind, F.lit(False)).alias("bw"),
        F.coalesce(valid & (z > Z_DETECT), F.lit(False)).alias("d"))
    d, t = F.col("d"), F.col("bp") | F.col("bw")
    counts = rows.groupBy("turbine_id").agg(
        F.count_if(t).alias("n_gt_anomalies"), F.count_if(d).alias("n_detected"),
        F.count_if(t & d).alias("tp"), F.count_if(~t & d).alias("fp"),
        F.count_if(t & ~d).alias("fn"), F.count_if(~t & ~d).alias("tn"),
        F.count_if("bp").alias("gt_power_anomalies"), F.count_if(F.col("bp") & d).alias("detected_power_anomalies"),
        F.count_if("bw").alias("gt_wind_curve_anomalies"),
        F.count_if(F.col("bw") & d).alias("detected_wind_curve_anomalies"))

    def precision(kind: str) -> Column:
        return F.coalesce(F.try_divide(F.col(kind), F.col("tp")), F.lit(0.0))

    return counts.withColumns({
        **_confusion(), "power_anomaly_precision": precision("detected_power_anomalies"),
        "wind_curve_anomaly_precision": precision("detected_wind_curve_anomalies")})


def risk_matrix(risks: DataFrame) -> DataFrame:
    """Mean stop-risk score per turbine and day."""
    return risks.groupBy("turbine_id", F.to_date("ts").cast("timestamp_ntz").alias("day")).agg(
        F.avg("stop_risk_score").alias("mean_score"))


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows in an order with no ties."""
    return df.orderBy(*order).limit(n)
