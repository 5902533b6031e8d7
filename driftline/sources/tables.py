"""Access to the given parquet tables and the inputs derived from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------------------
# Batch drift scenarios over lineitem (baseline: shipped before 1997)
# ---------------------------------------------------------------------------
DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BASELINE_END = "1997-01-01"

# scenario -> extra condition a current row must meet (None: every current row)
DRIFT_SCENARIOS = {
    "stable": None,
    "warn": "l_linenumber <= 3 OR l_extendedprice > 30000",
    "crit": "l_linenumber <= 2 OR l_quantity > 20",
}


def drift_scenarios(spark: SparkSession, sf_dir: str, scenarios: list[str] | None = None) -> DataFrame:
    """(scenario, side, features...) from a single lineitem scan: every baseline row once,
    without a scenario; a current row joins the scenarios whose condition it meets."""
    scenarios = scenarios or list(DRIFT_SCENARIOS)
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_linenumber", *DRIFT_FEATURES)
    is_base = F.col("l_shipdate") < F.lit(BASELINE_END).cast("timestamp_ntz")
    tags = [F.when(is_base, F.struct(F.lit(None).cast("string").alias("scenario"), F.lit("b").alias("side")))]
    for name in scenarios:
        cond = DRIFT_SCENARIOS[name]
        cur_ok = F.lit(True) if cond is None else F.expr(cond)
        tags.append(F.when(~is_base & cur_ok, F.struct(F.lit(name).alias("scenario"), F.lit("c").alias("side"))))
    # explode then drop the NULL tags (a lambda filter would leave whole-stage codegen)
    tagged = li.select(*DRIFT_FEATURES, F.explode(F.array(*tags)).alias("t")).where(F.col("t").isNotNull())
    return tagged.select("t.scenario", "t.side", *DRIFT_FEATURES)


def drift_sides(spark: SparkSession, sf_dir: str, scenario: str = "warn") -> tuple[DataFrame, DataFrame]:
    """Baseline and current frames of one scenario, as separate DataFrames (the
    shape a monitoring job receives).  The current side carries ``_snapshot_date``."""
    li = table(spark, sf_dir, "lineitem")
    is_base = F.col("l_shipdate") < F.lit(BASELINE_END).cast("timestamp_ntz")
    base = li.where(is_base).select(*DRIFT_FEATURES, "l_returnflag")
    cond = DRIFT_SCENARIOS[scenario]
    cur = li.where(~is_base)
    if cond is not None:
        cur = cur.where(F.expr(cond))
    cur = cur.select(*DRIFT_FEATURES, "l_returnflag", F.to_date("l_shipdate").alias("_snapshot_date"))
    return base, cur


# ---------------------------------------------------------------------------
# Inference event streams over events
# ---------------------------------------------------------------------------
def _k(col: str = "props"):
    return F.get_json_object(F.col(col), "$.k").cast("double")


def event_stream(spark: SparkSession, sf_dir: str, variant: str = "warm") -> DataFrame:
    """Typed inference events (event_id, model, ts, features map, prediction).

    * ``warm``: model = user_id (150 models); f1 = 100 + value/10, f2 = 100 + k/10,
      f3 = 100 + (value + k)/20.
    * ``steady``: model = event_type (5 long models); features value, k, user_id.
    * ``flat``: model = event_type; a constant, and a value that steps once and stays.
    """
    ev = table(spark, sf_dir, "events")
    return events_to_inference(ev, variant)


def events_to_inference(ev: DataFrame, variant: str = "warm") -> DataFrame:
    k = _k()
    if variant == "warm":
        model = F.col("user_id").cast("string")
        feats = F.create_map(
            F.lit("f1"), F.lit(100.0) + F.col("value") / F.lit(10.0),
            F.lit("f2"), F.lit(100.0) + k / F.lit(10.0),
            F.lit("f3"), F.lit(100.0) + (F.col("value") + k) / F.lit(20.0))
    elif variant == "steady":
        model = F.col("event_type")
        feats = F.create_map(F.lit("value"), F.col("value"), F.lit("k"), k,
                             F.lit("user_id"), F.col("user_id").cast("double"))
    elif variant == "flat":
        model = F.col("event_type")
        feats = F.create_map(F.lit("level"), F.lit(7.3), F.lit("step"),
                             F.when(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"), F.lit(100.0)).otherwise(F.lit(250.1)))
    else:
        raise ValueError(f"unknown event variant {variant!r}")
    return ev.select("event_id", model.alias("model"), F.col("ts"),
                     feats.alias("features"), F.col("value").alias("prediction"))


def event_payloads(spark: SparkSession, sf_dir: str, variant: str = "warm") -> DataFrame:
    """The events as JSON request bodies ``{"model", "timestamp", "features", "prediction"}``
    (epoch seconds), i.e. what the intake receives."""
    inf = event_stream(spark, sf_dir, variant)
    body = F.to_json(F.struct(
        F.col("model"), (F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / F.lit(1e6)).alias("timestamp"),
        F.col("features"), F.col("prediction")))
    return inf.select("event_id", body.alias("payload"))


# ---------------------------------------------------------------------------
# Inference snapshots (one per day) over events
# ---------------------------------------------------------------------------
def inference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot-shaped rows: timestamp, prediction_score, numeric features (feature_3
    is nullable: missing on error events), a string column, and ``snapshot_date``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("prediction_score"),
        F.col("user_id").cast("double").alias("feature_1"),
        _k().alias("feature_2"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value") / F.lit(10.0)).alias("feature_3"),
        F.col("event_type"),
        F.to_date(F.col("ts")).alias("snapshot_date"))
