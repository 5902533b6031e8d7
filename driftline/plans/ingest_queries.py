"""Registered queries of the ingestion / snapshot / retraining pipelines.

The daily snapshots are derived from ``events`` (one partition per day) and
written by Spark into a scratch folder under the shared checkpoint folder, then
read back through the same sources a pipeline uses.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.quality import (check_table, coerce_numeric, least_rows, may_be_empty, most_nulls, numeric, required,
                                         rules_of_schema)
from driftline.operators.retrain import model_registry, retrain_decisions
from driftline.plans.jobs import ingest_snapshots, late_days
from driftline.plans.monitor import monitor_tagged
from driftline.session import scratch_path
from driftline.sources.files import (SNAPSHOT_COL, load_recent, load_snapshot,
                                     load_training, read_snapshots, read_table, save_snapshots, write_table)
from driftline.sources.tables import inference_rows, table

SNAPSHOT_DAY = "2024-01-15"
RECENT_ANCHOR = "2024-01-20"
WINDOW_START, WINDOW_END = "2024-01-01", "2024-01-30"
LATE_DAYS = ["2024-01-10", "2024-01-21"]
TRAIN_PARQUET_LAST = "2024-01-20"
TRAIN_CSV_FIRST = "2024-01-15"
HISTORY_BASELINE_LAST = "2024-01-07"
HISTORY_FEATURES = ["prediction_score", "feature_1", "feature_2", "feature_3"]
# strict PSI limits, so that the small daily samples give all three outcomes
HISTORY_THRESHOLDS = {"psi": {"warning": 0.03, "critical": 0.05}, "mean_shift_pct": 1000.0, "var_shift_pct": 1000.0}
REGISTRY_LOGGED_AT = "2024-02-01T08:00:00.000000"
# the ingestion rules: timestamp and score required, score numeric, feature_3 may be null
INGEST_RULES = [*least_rows(10), *required("timestamp", "prediction_score"), *numeric("prediction_score"),
                *may_be_empty("feature_3"), *most_nulls(0.05)]
SNAPSHOT_COLUMNS = ["event_id", "timestamp", "prediction_score", "feature_1", "feature_2", "feature_3",
                    "event_type"]


def _rows(spark, sf_dir) -> DataFrame:
    return inference_rows(spark, sf_dir)


def _snapshot_root(spark, sf_dir, drop_days=()) -> str:
    root = scratch_path(spark, "snapshots")
    rows = _rows(spark, sf_dir)
    if drop_days:
        rows = rows.where(~F.col(SNAPSHOT_COL).isin([F.lit(d).cast("date") for d in drop_days]))
    save_snapshots(rows, root, "parquet")
    return root


def q_ingest_snapshot(spark, sf_dir) -> DataFrame:
    root = scratch_path(spark, "ingest")
    summary, _ = ingest_snapshots(_rows(spark, sf_dir), root, INGEST_RULES, WINDOW_START, WINDOW_END)
    saved = read_snapshots(spark, root).groupBy(SNAPSHOT_COL).agg(F.count(F.lit(1)).alias("rows_saved"))
    return summary.join(saved, on=SNAPSHOT_COL, how="left").select(
        SNAPSHOT_COL, "rows_in", "passed", "errors", "warnings",
        F.coalesce("rows_saved", F.lit(0)).alias("rows_saved"))


def q_dq_checks(spark, sf_dir) -> DataFrame:
    rows = _rows(spark, sf_dir)
    return check_table(rows, rules_of_schema(rows.drop(SNAPSHOT_COL).schema), [SNAPSHOT_COL])


def q_coerce_numeric(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    raw = ev.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                    F.col("event_type").alias("type_text"),
                    F.concat(F.col("value").cast("string"), F.lit("d")).alias("suffixed_text"),
                    F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")).alias("padded_text"))
    return coerce_numeric(raw, ["k_text", "type_text", "suffixed_text", "padded_text", "not_a_column"])


def q_scan_formats(spark, sf_dir) -> DataFrame:
    rows = _rows(spark, sf_dir).select("event_id", "prediction_score", "feature_2", "feature_3", "event_type")
    base = scratch_path(spark, "formats")
    out = None
    for fmt in ("parquet", "csv", "json"):
        path = os.path.join(base, f"events.{fmt.upper() if fmt == 'csv' else fmt}")
        write_table(rows, path, fmt)
        back = read_table(spark, path, schema=rows.schema if fmt != "parquet" else None)
        back = back.select(F.lit(fmt).alias("format"), *[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])
        out = back if out is None else out.unionByName(back)
    return out


def q_snapshot_day(spark, sf_dir) -> DataFrame:
    root = _snapshot_root(spark, sf_dir)
    return load_snapshot(spark, root, SNAPSHOT_DAY).select(*SNAPSHOT_COLUMNS, SNAPSHOT_COL)


def q_recent_inference(spark, sf_dir) -> DataFrame:
    root = _snapshot_root(spark, sf_dir)
    return load_recent(spark, root, RECENT_ANCHOR, 7).select(*SNAPSHOT_COLUMNS, "_snapshot_date")


def q_late_partitions(spark, sf_dir) -> DataFrame:
    root = _snapshot_root(spark, sf_dir, LATE_DAYS)
    return late_days(spark, root, WINDOW_START, WINDOW_END)


def q_training_dataset(spark, sf_dir) -> DataFrame:
    rows = _rows(spark, sf_dir)
    d = F.col(SNAPSHOT_COL)
    pq_root = scratch_path(spark, "train-parquet")
    csv_root = scratch_path(spark, "train-csv")
    save_snapshots(rows.where(d <= F.lit(TRAIN_PARQUET_LAST).cast("date")), pq_root, "parquet")
    save_snapshots(rows.where(d >= F.lit(TRAIN_CSV_FIRST).cast("date")), csv_root, "csv")
    out = load_training(spark, {"parquet": pq_root, "csv": csv_root}, WINDOW_END, 90, schema=rows.schema)
    return out.select(*SNAPSHOT_COLUMNS, "_snapshot_date")


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of every day after the baseline week, by the drift engine: one segment
    per day, all days in one job.  Checks take place at 8, 14 and 20 o'clock in turn."""
    rows = _rows(spark, sf_dir)
    day = F.col(SNAPSHOT_COL)
    last = F.lit(HISTORY_BASELINE_LAST).cast("date")
    # one scan: the baseline week has no run date and counts for every day
    tagged = rows.select(*HISTORY_FEATURES, F.when(day > last, day).alias("run_date"), F.when(day > last, "c").otherwise("b").alias("side"))
    found = monitor_tagged(tagged, HISTORY_FEATURES, ["run_date"], HISTORY_THRESHOLDS, shared=True)
    at = F.col("run_date").cast("timestamp") + F.make_interval(hours=F.lit(8) + F.day("run_date") % 3 * 6)
    return found.overall.select(F.lit("inference").alias("pipeline"), "run_date", "overall_status", at.alias("evaluated_at"))


def q_retrain_decisions(spark, sf_dir) -> DataFrame:
    return retrain_decisions(run_history(spark, sf_dir))


def q_model_registry(spark, sf_dir) -> DataFrame:
    return model_registry(retrain_decisions(run_history(spark, sf_dir)), logged_at=REGISTRY_LOGGED_AT)


QUERIES = {
    "ingest_snapshot": q_ingest_snapshot,
    "dq_checks": q_dq_checks,
    "coerce_numeric": q_coerce_numeric,
    "scan_formats": q_scan_formats,
    "snapshot_day": q_snapshot_day,
    "recent_inference": q_recent_inference,
    "late_partitions": q_late_partitions,
    "training_dataset": q_training_dataset,
    "retrain_decisions": q_retrain_decisions,
    "model_registry": q_model_registry,
}
