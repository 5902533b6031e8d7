"""Registered batch-drift queries over lineitem (segments = scenario)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.numeric import significant
from driftline.operators.drift import DriftTables, feature_columns
from driftline.plans.monitor import DriftResult, monitor_tagged
from driftline.sources.tables import DRIFT_FEATURES, drift_scenarios, drift_sides

RUN_DATE = "1998-12-01"
SEGMENTS = ["scenario"]


def run(spark: SparkSession, sf_dir: str) -> DriftResult:
    tagged = drift_scenarios(spark, sf_dir)
    return monitor_tagged(tagged, DRIFT_FEATURES, SEGMENTS, shared=True)


def comparable(df: DataFrame) -> DataFrame:
    """The engine's six decimals, compared to ten significant digits."""
    return df.withColumns({c: significant(c) for c in ("baseline_mean", "current_mean", "baseline_var", "current_var")})


def q_drift_features(spark, sf_dir) -> DataFrame:
    baseline, current = drift_sides(spark, sf_dir)
    return DriftTables(drift_scenarios(spark, sf_dir), feature_columns(baseline, current), SEGMENTS, shared=True).sizes()


def q_psi_edges(spark, sf_dir) -> DataFrame:
    e = run(spark, sf_dir).tables.edges()
    return e.select("scenario", "feature_idx", "feature",
                    F.posexplode("edges").alias("edge_idx", "edge"))


def q_psi_bins(spark, sf_dir) -> DataFrame:
    b = run(spark, sf_dir).tables.psi_bins()
    return b.select("scenario", "feature_idx", "feature", "bin", "lower", "upper",
                    "count_baseline", "count_current", "pct_baseline", "pct_current")


def q_drift_psi(spark, sf_dir) -> DataFrame:
    return run(spark, sf_dir).psi


def q_drift_ks(spark, sf_dir) -> DataFrame:
    return run(spark, sf_dir).ks


def q_drift_shift(spark, sf_dir) -> DataFrame:
    return comparable(DriftTables(drift_scenarios(spark, sf_dir), DRIFT_FEATURES, SEGMENTS, shared=True).shift())


def q_feature_verdicts(spark, sf_dir) -> DataFrame:
    return run(spark, sf_dir).verdicts.select("scenario", "feature_idx", "feature", "status")


def q_drift_verdict(spark, sf_dir) -> DataFrame:
    return run(spark, sf_dir).overall


def q_drift_report(spark, sf_dir) -> DataFrame:
    return comparable(run(spark, sf_dir).report(RUN_DATE))


def q_drift_alerts(spark, sf_dir) -> DataFrame:
    return run(spark, sf_dir).alerts(RUN_DATE)


QUERIES = {
    "drift_features": q_drift_features,
    "psi_edges": q_psi_edges,
    "psi_bins": q_psi_bins,
    "drift_psi": q_drift_psi,
    "drift_ks": q_drift_ks,
    "drift_shift": q_drift_shift,
    "feature_verdicts": q_feature_verdicts,
    "drift_verdict": q_drift_verdict,
    "drift_report": q_drift_report,
    "drift_alerts": q_drift_alerts,
}
