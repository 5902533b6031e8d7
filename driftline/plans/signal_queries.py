"""Registered queries of the signal engine over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.numeric import round_half_even
from driftline.operators import reads
from driftline.operators.scoring import predictions
from driftline.operators.signals import compute_signals, explode_features, model_state, signal_rows
from driftline.plans import stored
from driftline.sources.files import parse_events
from driftline.sources.tables import event_payloads, event_stream


def all_rows(spark: SparkSession, sf_dir: str, variant: str = "warm") -> DataFrame:
    return compute_signals(explode_features(event_stream(spark, sf_dir, variant), keep_empty=True))


def q_parse_events(spark, sf_dir) -> DataFrame:
    """Events as JSON request bodies, parsed back into typed rows (intake)."""
    p = parse_events(event_payloads(spark, sf_dir, "warm"))
    return p.select("event_id", "model", "ts",
                    *[F.col("features").getItem(f).alias(f) for f in ("f1", "f2", "f3")],
                    "prediction", "valid")


def q_explode_features(spark, sf_dir) -> DataFrame:
    return explode_features(event_stream(spark, sf_dir, "warm"))


def q_baseline_ema(spark, sf_dir) -> DataFrame:
    r = all_rows(spark, sf_dir, "steady")
    return r.select("event_id", "model", "feature", "t",
                    round_half_even("baseline_mean", 6).alias("baseline_mean"),
                    round_half_even("baseline_std", 6).alias("baseline_std"))


def q_signals(spark, sf_dir) -> DataFrame:
    return signal_rows(all_rows(spark, sf_dir, "warm"))


def q_signals_steady(spark, sf_dir) -> DataFrame:
    return signal_rows(all_rows(spark, sf_dir, "steady"))


def q_signals_flat(spark, sf_dir) -> DataFrame:
    """Long flat keys: a constant feature, and a step followed by equal values."""
    return signal_rows(all_rows(spark, sf_dir, "flat"))


def q_model_state(spark, sf_dir) -> DataFrame:
    return model_state(all_rows(spark, sf_dir, "warm"))


def q_model_prediction(spark, sf_dir) -> DataFrame:
    p = predictions(all_rows(spark, sf_dir, "warm"))
    return p.select("event_id", "model", "risk", "time_to_failure", "confidence", "root_cause",
                    "avg_drift", "avg_velocity", "avg_acceleration", "ts")


def q_time_to_failure(spark, sf_dir) -> DataFrame:
    p = predictions(all_rows(spark, sf_dir, "warm"))
    return p.select("event_id", "model", "avg_drift", "avg_velocity", "avg_acceleration",
                    "time_to_failure", "ttf_branch")


def q_prediction_steady(spark, sf_dir) -> DataFrame:
    p = predictions(all_rows(spark, sf_dir, "steady"))
    return p.select("event_id", "model", "risk", "time_to_failure", "confidence", "root_cause",
                    "avg_drift", "avg_velocity", "avg_acceleration", "ts")


def q_signals_recent(spark, sf_dir) -> DataFrame:
    sig = stored.signals(spark, sf_dir)
    return reads.latest(sig, n=100, model=None)


def q_signals_recent_model(spark, sf_dir) -> DataFrame:
    sig = stored.signals(spark, sf_dir)
    return reads.latest(sig, n=100, model="7")


def q_events_recent(spark, sf_dir) -> DataFrame:
    ev = event_stream(spark, sf_dir, "warm")
    return reads.latest(ev.select("event_id", "model", "ts", F.size("features").alias("n_features"),
                                  "prediction"), n=100, model=None)


def q_prediction_history(spark, sf_dir) -> DataFrame:
    pred = stored.scored(spark, sf_dir)
    return reads.latest(reads.prediction_table(pred), n=100, model="42")


def q_latest_prediction(spark, sf_dir) -> DataFrame:
    pred = stored.scored(spark, sf_dir)
    return reads.latest_overall(reads.prediction_table(pred))


def q_latest_of_model(spark, sf_dir) -> DataFrame:
    """Latest prediction of one model, and the default row for a model without any."""
    pred = reads.prediction_table(stored.scored(spark, sf_dir))
    return reads.latest_of_model(pred, "42").unionByName(reads.latest_of_model(pred, "no such model"))


def q_latest_predictions(spark, sf_dir) -> DataFrame:
    pred = stored.scored(spark, sf_dir)
    return reads.latest_per_model(reads.prediction_table(pred))


def q_recent_trajectory(spark, sf_dir) -> DataFrame:
    pred = stored.scored(spark, sf_dir)
    return reads.trailing_trajectory(pred, points=51)


def q_active_models(spark, sf_dir) -> DataFrame:
    ev = event_stream(spark, sf_dir, "warm")
    return reads.active_models(ev, window=1000)


def q_pipeline_metrics(spark, sf_dir) -> DataFrame:
    ev = event_stream(spark, sf_dir, "warm")
    sig, pred = stored.signals(spark, sf_dir), stored.scored(spark, sf_dir)
    return reads.pipeline_metrics(ev, sig, pred)


QUERIES = {
    "parse_events": q_parse_events,
    "explode_features": q_explode_features,
    "baseline_ema": q_baseline_ema,
    "signals": q_signals,
    "signals_steady": q_signals_steady,
    "signals_flat": q_signals_flat,
    "model_state": q_model_state,
    "model_prediction": q_model_prediction,
    "time_to_failure": q_time_to_failure,
    "prediction_steady": q_prediction_steady,
    "signals_recent": q_signals_recent,
    "signals_recent_model": q_signals_recent_model,
    "events_recent": q_events_recent,
    "prediction_history": q_prediction_history,
    "latest_prediction": q_latest_prediction,
    "latest_of_model": q_latest_of_model,
    "latest_predictions": q_latest_predictions,
    "recent_trajectory": q_recent_trajectory,
    "active_models": q_active_models,
    "pipeline_metrics": q_pipeline_metrics,
}
