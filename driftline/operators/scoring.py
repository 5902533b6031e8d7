"""Per-event model prediction from the feature signals of that event.

Means are taken over the *rounded* feature signals, in the order the features
appear in the event (a left fold, as numpy adds fewer than eight values);
velocities and accelerations that round to 0 are left out of their means.
Risk and time to failure use the unrounded means; the root cause uses the means
rounded to 4 / 6 decimals.  An event whose features are all first values
(no history yet) gets the "initializing" row: UNKNOWN / NULL / LOW / EARLY_WARNING.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.numeric import ordered_sum_expr, round_half_even

# Risk thresholds on the mean drift / velocity / acceleration,
# failure threshold 0.25, 60 minutes per step, confidence sample / feature cut-offs,
# and root-cause thresholds.
RISK_MEDIUM_DRIFT = 0.15
RISK_HIGH_DRIFT = 0.25
RISK_HIGH_VELOCITY = 0.01
RISK_CRITICAL_DRIFT = 0.4
RISK_CRITICAL_ACCELERATION = 0.001
FAILURE_THRESHOLD = 0.25
MINUTES_PER_STEP = 60
LONGEST = 2 ** 63 - 1  # a long's largest value
CONF_LOW_SAMPLES, CONF_LOW_FEATURES = 10, 2
CONF_MEDIUM_SAMPLES, CONF_MEDIUM_FEATURES = 50, 3
ROOT_DATA_ACCELERATION = 0.002
ROOT_MODEL_VELOCITY = 0.02
ROOT_DATA_DRIFT = 0.25


def risk_expr(d, v, a):
    return (F.when(F.coalesce(d > RISK_CRITICAL_DRIFT, F.lit(False)) | (a > RISK_CRITICAL_ACCELERATION), "CRITICAL")
            .when((d > RISK_HIGH_DRIFT) | (v > RISK_HIGH_VELOCITY), "HIGH")
            .when(d > RISK_MEDIUM_DRIFT, "MEDIUM")
            .otherwise("LOW"))


def ttf_branch_expr(d, v, a):
    return (F.when(d >= FAILURE_THRESHOLD, "zero")
            .when((v <= 0) & (a <= 0), "none")
            .when(v > 0, "linear")
            .otherwise("quadratic"))


def _whole_minutes(steps):
    """At least 1.  Velocities of opposite sign can leave a mean of rounding size (1e-22), which is
    still positive: the minutes are then more than a long holds, and its largest value stands."""
    minutes = steps * F.lit(float(MINUTES_PER_STEP))
    return F.when(minutes < F.lit(float(LONGEST)), F.greatest(F.lit(1), minutes.cast("long"))).otherwise(F.lit(LONGEST))


def ttf_expr(d, v, a):
    """Minutes to the failure threshold (NULL when not trending towards it)."""
    thr = F.lit(FAILURE_THRESHOLD)
    linear = _whole_minutes((thr - d) / v)
    half_a = F.lit(0.5) * a
    disc = v * v - F.lit(4.0) * half_a * (d - thr)
    root = (-v + F.sqrt(disc)) / (F.lit(2.0) * half_a)
    quad = _whole_minutes(root)
    return (F.when(d >= thr, F.lit(0).cast("long"))
            .when((v <= 0) & (a <= 0), F.lit(None).cast("long"))
            .when(v > 0, linear)
            .when((a > 0) & (disc >= 0) & (root > 0), quad)
            .otherwise(F.lit(None).cast("long")))


def confidence_expr(avg_samples, n_features):
    return (F.when((avg_samples < CONF_LOW_SAMPLES) | (n_features < CONF_LOW_FEATURES), "LOW")
            .when((avg_samples < CONF_MEDIUM_SAMPLES) | (n_features < CONF_MEDIUM_FEATURES), "MEDIUM")
            .otherwise("HIGH"))


def root_cause_expr(rd, rv, ra):
    return (F.when(ra > ROOT_DATA_ACCELERATION, "DATA")
            .when(rv > ROOT_MODEL_VELOCITY, "MODEL")
            .when(rd > ROOT_DATA_DRIFT, "DATA")
            .otherwise("EARLY_WARNING"))


def predictions(all_rows: DataFrame) -> DataFrame:
    """One row per event from the signal rows (seeds included, t = 0)."""
    sig = F.col("t") >= 1
    per = all_rows.groupBy("event_id", "model").agg(
        F.max("ts").alias("ts"),
        F.array_sort(F.collect_list(F.when(sig, F.struct("fpos", "drift", "velocity", "acceleration",
                                                          "samples")))).alias("f"))
    per = per.select(
        "event_id", "model", "ts",
        F.transform("f", lambda x: x["drift"]).alias("ds"),
        F.filter(F.transform("f", lambda x: x["velocity"]), lambda y: y != 0).alias("vs"),
        F.filter(F.transform("f", lambda x: x["acceleration"]), lambda y: y != 0).alias("as_"),
        F.transform("f", lambda x: x["samples"].cast("double")).alias("ss"))
    n = F.size("ds")
    d = F.try_divide(F.expr(ordered_sum_expr("ds")), n.cast("double"))
    v = F.when(F.size("vs") > 0, F.expr(ordered_sum_expr("vs")) / F.size("vs").cast("double")).otherwise(F.lit(0.0))
    a = F.when(F.size("as_") > 0, F.expr(ordered_sum_expr("as_")) / F.size("as_").cast("double")).otherwise(F.lit(0.0))
    s = F.try_divide(F.expr(ordered_sum_expr("ss")), n.cast("double"))
    per = per.select("event_id", "model", "ts", n.alias("n_features"),
                     d.alias("d"), v.alias("v"), a.alias("a"), s.alias("avg_samples"))
    d, v, a = F.col("d"), F.col("v"), F.col("a")
    rd, rv, ra = round_half_even(d, 4), round_half_even(v, 6), round_half_even(a, 6)
    init = F.col("n_features") == 0
    return per.select(
        "event_id", "model",
        F.when(init, "UNKNOWN").otherwise(risk_expr(d, v, a)).alias("risk"),
        F.when(init, F.lit(None).cast("long")).otherwise(ttf_expr(d, v, a)).alias("time_to_failure"),
        F.when(init, "LOW").otherwise(confidence_expr(F.col("avg_samples"), F.col("n_features"))).alias("confidence"),
        F.when(init, "EARLY_WARNING").otherwise(root_cause_expr(rd, rv, ra)).alias("root_cause"),
        F.when(~init, rd).alias("avg_drift"), F.when(~init, rv).alias("avg_velocity"),
        F.when(~init, ra).alias("avg_acceleration"),
        F.when(init, "initializing").otherwise(ttf_branch_expr(d, v, a)).alias("ttf_branch"),
        "n_features", "ts")
