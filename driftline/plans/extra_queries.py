"""Registered queries of the documented-only capabilities (our semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.extras import (embedding_cohesion, feature_correlation, kl_divergence, risk_entropy, rolling_stats,
                                       signal_fusion)
from driftline.operators.signals import KEYS, explode_features, positions
from driftline.operators.verdict import drift_alert_payloads, retrain_notices
from driftline.plans import drift_queries, ingest_queries, stored
from driftline.plans.monitor import monitor_tagged
from driftline.sources.tables import BASELINE_END, DRIFT_FEATURES, event_stream, table


def q_drift_kl(spark, sf_dir) -> DataFrame:
    return kl_divergence(drift_queries.run(spark, sf_dir).tables)


def q_segment_psi(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    side = F.when(F.col("l_shipdate") < F.lit(BASELINE_END).cast("timestamp_ntz"), "b").otherwise("c")
    tagged = li.select(F.col("l_returnflag").alias("segment"), side.alias("side"), *DRIFT_FEATURES)
    res = monitor_tagged(tagged, DRIFT_FEATURES, ["segment"])
    return res.psi


def q_rolling_stats(spark, sf_dir) -> DataFrame:
    rows = positions(explode_features(event_stream(spark, sf_dir, "warm")))
    return rolling_stats(rows, KEYS, "x", "t")


def q_embedding_cohesion(spark, sf_dir) -> DataFrame:
    return embedding_cohesion(table(spark, sf_dir, "embeddings"))


def q_risk_entropy(spark, sf_dir) -> DataFrame:
    return risk_entropy(stored.scored(spark, sf_dir))


def q_feature_correlation(spark, sf_dir) -> DataFrame:
    return feature_correlation(event_stream(spark, sf_dir, "steady"))


def q_alert_payloads(spark, sf_dir) -> DataFrame:
    """The message bodies of the drift alerts."""
    made = drift_alert_payloads(drift_queries.q_drift_alerts(spark, sf_dir))
    return made.select("scenario", "severity", "payload")


def q_retrain_notices(spark, sf_dir) -> DataFrame:
    return retrain_notices(ingest_queries.q_model_registry(spark, sf_dir))


def q_signal_fusion(spark, sf_dir) -> DataFrame:
    return signal_fusion(stored.scored(spark, sf_dir))


QUERIES = {
    "signal_fusion": q_signal_fusion,
    "feature_correlation": q_feature_correlation,
    "alert_payloads": q_alert_payloads,
    "retrain_notices": q_retrain_notices,
    "drift_kl": q_drift_kl,
    "segment_psi": q_segment_psi,
    "rolling_stats": q_rolling_stats,
    "embedding_cohesion": q_embedding_cohesion,
    "risk_entropy": q_risk_entropy,
}
