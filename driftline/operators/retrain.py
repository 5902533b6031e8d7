"""Retraining decisions over the history of drift runs.

Each run is monitored and then checked for retraining.  A critical run raises the
pipeline's counter, a healthy one leaves it.  At ``consecutive_runs_before_retrain`` a
retrain is requested, and the request stays until a check inside the allowed hours
grants it; that resets the counter.  A check's hour is the hour of ``evaluated_at`` (the
fixed ``check_hour`` where the history has none), so hours may be mixed.

A pipeline's runs (one a day) are folded in order by ``aggregate``; pipelines are
independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.config import thresholds as merge_thresholds

RETRAIN_DAG = "retraining_trigger"
CHECK_HOUR = 8   # the retraining check runs at 08:00 UTC


def retrain_decisions(runs: DataFrame, thresholds: dict | None = None, check_hour: int = CHECK_HOUR,
                      pipeline_col: str = "pipeline") -> DataFrame:
    """``runs``: (pipeline, run_date, overall_status[, evaluated_at]) -> one decision row per run."""
    th = merge_thresholds(thresholds)
    need, hours = int(th["consecutive_runs_before_retrain"]), th["retrain_allowed_hours"]
    hour = F.coalesce(F.hour("evaluated_at"), F.lit(check_hour)) if "evaluated_at" in runs.columns else F.lit(check_hour)
    run = F.struct("run_date", "overall_status", ((hour >= hours["start"]) & (hour < hours["end"])).alias("open"))
    history = runs.groupBy(pipeline_col).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    row = "struct<run_date:date,overall_status:string,n:bigint,requested:boolean,granted:boolean>"
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast(f"array<{row}>").alias("rows"))

    def step(acc: Column, r: Column) -> Column:
        n = acc["n"] + (r["overall_status"] == "critical").cast("long")
        granted = (n >= need) & r["open"]
        made = F.struct(r["run_date"].alias("run_date"), r["overall_status"].alias("overall_status"), n.alias("n"),
                        (n >= need).alias("requested"), granted.alias("granted"))
        return F.struct(F.when(granted, F.lit(0).cast("long")).otherwise(n).alias("n"),
                        F.concat(acc["rows"], F.array(made)).alias("rows"))

    rows = history.select(pipeline_col, F.inline(F.aggregate("runs", start, step)["rows"]))
    return rows.select(
        pipeline_col, "run_date", "overall_status",
        F.col("overall_status").isin("warning", "critical").alias("should_alert"),
        (F.col("overall_status") == "critical").alias("should_retrain"),
        F.col("n").alias("consecutive_count"), F.col("requested").alias("retrain_requested"),
        F.col("granted").alias("retrain_triggered"),
        F.when(F.col("granted"), F.lit(0).cast("long")).otherwise(F.col("n")).alias("counter_after"))


def model_registry(decisions: DataFrame, dag_id: str = RETRAIN_DAG, logged_at: str | None = None,
                   pipeline_col: str = "pipeline") -> DataFrame:
    """One registry record per triggered retrain.

    The version hashes the pipeline, the run date and the logging time, which is that of the
    day's check if none is given: a record reads the same whenever it is computed."""
    day = F.date_format(F.col("run_date"), "yyyy-MM-dd")
    now = F.lit(logged_at) if logged_at else F.concat(day, F.lit(f"T{CHECK_HOUR:02d}:00:00.000000"))
    run_id = F.substring(F.sha1(F.concat_ws("|", F.col(pipeline_col), day, now)), 1, 10)
    return decisions.where("retrain_triggered").select(
        F.col(pipeline_col),
        F.concat(F.lit("v_"), F.regexp_replace(day, "-", ""), F.lit("_"), run_id).alias("model_version"),
        run_id.alias("run_id"), day.alias("retrain_date"),
        F.lit("drift_threshold_breached").alias("trigger_reason"),
        F.col("consecutive_count").alias("consecutive_drift_runs"),
        F.lit(dag_id).alias("dag_id"), now.alias("logged_at"))
