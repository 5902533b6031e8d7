"""Read side over the events / signals / predictions tables.

Top-N reads are ``orderBy(...).limit(n)`` (Spark plans them as a distributed
partial top-k, TakeOrderedAndProject); ties on the timestamp are broken by
``event_id`` (and feature) descending.  Per-model reads aggregate with
``max_by`` (map-side partial aggregation, safe for a hot model) or use a
``row_number() <= k`` filter, which Spark turns into a per-partition group limit
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The default prediction returned when there is none.
DEFAULT_PREDICTION = {"model": "unknown", "risk": "LOW", "confidence": "LOW", "root_cause": "NONE"}
PREDICTION_COLS = ["event_id", "model", "risk", "time_to_failure", "confidence", "root_cause", "ts"]


def _order(df: DataFrame) -> list:
    cols = [F.col("ts").desc(), F.col("event_id").desc()]
    if "feature" in df.columns:
        cols.append(F.col("feature").desc())
    return cols


def latest(df: DataFrame, n: int = 100, model: str | None = None) -> DataFrame:
    """Latest ``n`` rows, optionally of one model (default 100)."""
    if model is not None:
        df = df.where(F.col("model") == F.lit(model))
    return df.orderBy(*_order(df)).limit(n)


def prediction_table(pred: DataFrame) -> DataFrame:
    return pred.select(*PREDICTION_COLS)


def _default(pred: DataFrame, model: str) -> DataFrame:
    """The one row that stands for "no prediction yet"."""
    known = {"model": model, **{k: v for k, v in DEFAULT_PREDICTION.items() if k != "model"}}
    return pred.sparkSession.range(1).select(
        *[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in pred.schema.fields])


def _or_default(found: DataFrame, default: DataFrame) -> DataFrame:
    """``found``, or the default row if it is empty: one bit is read by the driver."""
    return found if found.take(1) else default


def latest_per_model(pred: DataFrame) -> DataFrame:
    """Latest prediction of every model; one default row when there is none."""
    cols = [c for c in pred.columns if c != "model"]
    last = pred.groupBy("model").agg(F.max_by(F.struct(*cols), F.struct("ts", "event_id")).alias("p"))
    out = last.select("model", *[F.col(f"p.{c}").alias(c) for c in cols]).select(*pred.columns)
    return out if pred.take(1) else _default(pred, DEFAULT_PREDICTION["model"])


def latest_of_model(pred: DataFrame, model: str) -> DataFrame:
    """Latest prediction of one model, or the default row under its name."""
    return _or_default(latest(pred, n=1, model=model), _default(pred, model))


def latest_overall(pred: DataFrame) -> DataFrame:
    return _or_default(latest(pred, n=1), _default(pred, DEFAULT_PREDICTION["model"]))


def trailing_trajectory(pred: DataFrame, points: int = 51) -> DataFrame:
    """Last ``points`` predictions of every model (the dashboard's trailing chart)."""
    w = Window.partitionBy("model").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    ranked = pred.withColumn("point", F.row_number().over(w))
    return ranked.where(F.col("point") <= points).select(
        "model", "point", "event_id", "ts", "risk", "avg_drift", "avg_velocity", "avg_acceleration")


def active_models(events: DataFrame, window: int = 1000) -> DataFrame:
    """Distinct models among the latest ``window`` events, sorted."""
    recent = events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(window)
    return recent.select("model").distinct().orderBy("model")


def pipeline_metrics(events: DataFrame, signals: DataFrame, pred: DataFrame) -> DataFrame:
    """Events processed, signals computed, predictions generated (one aggregate)."""
    tagged = (events.select(F.lit("e").alias("k"))
              .unionByName(signals.select(F.lit("s").alias("k")))
              .unionByName(pred.select(F.lit("p").alias("k"))))
    return tagged.agg(
        F.count_if(F.col("k") == "e").alias("events_processed"),
        F.count_if(F.col("k") == "s").alias("signals_computed"),
        F.count_if(F.col("k") == "p").alias("predictions_generated"))
