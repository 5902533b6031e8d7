"""Composed jobs: ingestion (G1), drift monitoring (G2), retraining (G3).
Live scoring (G4) is :func:`driftline.streaming.live.run_live`.

Each job is a few DataFrame writes; branching is a filter on small result
tables, and the driver reads at most one decision row.
"""

from __future__ import annotations

import os

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.drift import feature_columns, tag_sides
from driftline.operators.quality import Rule, check_table, stop_on_errors, validation_summary
from driftline.operators.retrain import model_registry, retrain_decisions
from driftline.operators.verdict import drift_alert_payloads, retrain_notices, write_report_json
from driftline.plans.monitor import DriftResult, monitor_tagged
from driftline.sources.files import (REJECTED, SNAPSHOT_COL, _drop, _reader, late_partitions, load_baseline, load_raw, load_recent,
                                     load_training, overwrite_partitions, present_days, promote, record_days,
                                     stage_snapshots)

INGEST_DAG = "inference_data_ingestion"
MONITOR_DAG = "drift_monitoring"
MONITOR_HOUR = 6   # the monitor runs at 06:00 UTC


def ingest_snapshots(raw: DataFrame, root: str, rules: list[Rule], start: str, end: str,
                     fmt: str = "parquet", stop: bool = False) -> tuple[DataFrame, DataFrame]:
    """G1 for every day in [start, end] at once: validated per day while it is written.

    The raw rows are read once, into a staging folder; the checks read what was staged.
    Passing days are moved to their place, failing ones to ``_rejected``.  Returns (per-day
    summary, late days: those without rows); with ``stop`` failing days raise, after the
    others are saved."""
    spark = raw.sparkSession
    window = raw.where(F.col(SNAPSHOT_COL).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    staging = stage_snapshots(window, root, fmt)
    staged = _reader(spark, fmt, window.schema).load(staging)
    checks = check_table(staged, rules, [SNAPSHOT_COL])
    days = validation_summary(checks, [SNAPSHOT_COL])
    found = days.collect()   # a row per day
    summary = spark.createDataFrame(found, days.schema)
    passed = {str(r[SNAPSHOT_COL]): r["rows_in"] for r in found if r["passed"]}
    failed = sorted(str(r[SNAPSHOT_COL]) for r in found if not r["passed"])
    promote(spark, staging, root, sorted(passed))
    record_days(spark, root, fmt, passed, window.schema)
    if failed:
        promote(spark, staging, os.path.join(root, REJECTED), failed)
    _drop(spark, staging)
    late = late_partitions(summary.select(SNAPSHOT_COL), start, end)
    if stop and failed:
        rejected = _reader(spark, fmt, window.schema).load(os.path.join(root, REJECTED))
        stop_on_errors(check_table(rejected.where(F.col(SNAPSHOT_COL).cast("string").isin(failed)), rules, [SNAPSHOT_COL]))
    return summary, late


def ingest_day(spark: SparkSession, raw_folder: str, root: str, rules: list[Rule], run_date: str, schema=None) -> str:
    """G1 for one day: its raw log, in the first format there is.  ``saved``, or ``late`` if
    there is no log yet; a log that fails its checks raises."""
    try:
        raw = load_raw(spark, raw_folder, run_date, schema)
    except FileNotFoundError:
        return "late"
    ingest_snapshots(raw.withColumn(SNAPSHOT_COL, F.lit(date.fromisoformat(run_date))), root, rules, run_date, run_date, stop=True)
    return "saved"


def late_days(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """The days of [start, end] without a snapshot, by the manifest."""
    return late_partitions(present_days(spark, root), start, end)


def run_drift_monitor(spark: SparkSession, baseline: DataFrame | str, snapshot_root: str, run_date: str, results_root: str,
                      n_days: int = 7, thresholds: dict | None = None, evaluated_at: str | None = None) -> DriftResult:
    """G2: baseline (a table or the path of its file) vs the last ``n_days`` snapshots.

    Metrics, verdicts and alerts are kept per run date and the nested report as JSON; a rerun
    of a day replaces that day.  ``evaluated_at`` is the time that the retraining gate looks
    at; unless given, the monitor's hour of the run date, also in a later backfill."""
    if isinstance(baseline, str):
        baseline = load_baseline(spark, baseline)
    current = load_recent(spark, snapshot_root, run_date, n_days)
    features = feature_columns(baseline, current)
    res = monitor_tagged(tag_sides(baseline, current, features), features, [], thresholds, p_value_method="finite", shared=True)
    day = F.lit(run_date).cast("date")
    at = F.lit(evaluated_at or f"{run_date} {MONITOR_HOUR:02d}:00:00").cast("timestamp")
    made = {"psi": res.psi, "ks": res.ks, "shift": res.shift, "alerts": drift_alert_payloads(res.alerts(run_date, MONITOR_DAG)),
            "verdicts": res.overall.withColumn("evaluated_at", at)}
    for name, df in made.items():
        overwrite_partitions(df.withColumn("run_date", day), os.path.join(results_root, name), "parquet", "run_date")
    write_report_json(res.report(run_date, MONITOR_DAG).withColumn("_one", F.lit(1)), ["_one"],
                      os.path.join(results_root, "report", f"run_date={run_date}"))
    return res


def plan_retraining(spark: SparkSession, history: DataFrame, snapshot_roots: dict[str, str], run_date: str,
                    out_root: str, thresholds: dict | None = None) -> list[dict]:
    """G3: decide for every pipeline from the verdict history.  If any retrain is triggered
    for ``run_date``, write the 90-day training set, the registry records and their notices,
    by run date and pipeline: a rerun replaces its own.  Returns one entry per pipeline that
    ran on that day."""
    decisions = retrain_decisions(history, thresholds)
    today = decisions.where(F.col("run_date") == F.lit(run_date).cast("date"))
    rows = today.orderBy("pipeline").collect()  # one row per pipeline
    out = [{"pipeline": r["pipeline"], "run_date": run_date, "retrain_triggered": r["retrain_triggered"]} for r in rows]
    if any(r["retrain_triggered"] for r in rows):
        path = os.path.join(out_root, "training", f"run_date={run_date}")
        load_training(spark, snapshot_roots, run_date).write.mode("overwrite").parquet(path)
        registry = model_registry(today)
        keyed = {"model_registry": registry, "notices": retrain_notices(registry)}
        for name, df in keyed.items():
            overwrite_partitions(df, os.path.join(out_root, name), "json", "retrain_date", "pipeline")
        records = {r["pipeline"]: r.asDict() for r in registry.collect()}
        for entry in out:
            if entry["retrain_triggered"]:
                entry.update(records[entry["pipeline"]], dataset=path)
    return out
