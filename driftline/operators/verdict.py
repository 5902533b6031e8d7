"""Verdicts over the drift metric frames, the flattened report and alert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.config import thresholds as merge_thresholds
from driftline.functions.severity import rank_of, status_of

# Alert colours per severity (unknown severities use the warning colour),
# the status emoji, and the texts of the drift alert.
SEVERITY_COLORS = {"ok": "#36a64f", "warning": "#ffcc00", "critical": "#ff0000"}
SEVERITY_EMOJI = {"ok": "✅", "warning": "⚠️", "critical": "\U0001f6a8"}
UNKNOWN_EMOJI = "❓"
ALERT_TITLE = "*ML Drift Alert*"
TRIGGER_REASON = "drift_threshold_breached"


def feature_verdicts(psi: DataFrame, ks: DataFrame, shift: DataFrame, keys: list[str],
                     thresholds: dict | None = None) -> DataFrame:
    """(keys..., status, rank): PSI severity, raised to at least warning by a KS
    drift or by a mean / variance shift over its threshold; only PSI gives critical."""
    th = merge_thresholds(thresholds)
    r_psi = psi.select(*keys, rank_of(F.col("severity")).alias("rank"))
    r_ks = ks.select(*keys, F.when(F.col("drifted"), 1).otherwise(0).alias("rank"))
    shifted = (F.coalesce(F.col("mean_shift_pct") > F.lit(float(th["mean_shift_pct"])), F.lit(False))
               | F.coalesce(F.col("var_shift_pct") > F.lit(float(th["var_shift_pct"])), F.lit(False)))
    r_shift = shift.select(*keys, F.when(shifted, 1).otherwise(0).alias("rank"))
    ranks = r_psi.unionByName(r_ks).unionByName(r_shift)
    out = ranks.groupBy(*keys).agg(F.max("rank").alias("rank"))
    return out.select(*keys, status_of(F.col("rank")).alias("status"), "rank")


def overall_verdict(verdicts: DataFrame, segments: list[str]) -> DataFrame:
    """One row per segment: overall status, alert / retrain flags, counts, summary."""
    agg = verdicts.groupBy(*segments).agg(
        F.max("rank").alias("rank"),
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("rank") > 0).alias("n_drifted"))
    # nothing compared (no shared feature) counts as one feature that is ok
    agg = agg.withColumn("rank", F.coalesce("rank", F.lit(0))).withColumn("n_features", F.greatest("n_features", F.lit(1).cast("long")))
    status = status_of(F.col("rank"))
    return agg.select(
        *segments,
        status.alias("overall_status"),
        (F.col("rank") >= 1).alias("should_alert"),
        (F.col("rank") >= 2).alias("should_retrain"),
        "n_drifted", "n_features",
        F.format_string("Drift evaluation complete. Status=%s. %d/%d features drifted.",
                        status, F.col("n_drifted"), F.col("n_features")).alias("summary"))


def drift_report(psi: DataFrame, ks: DataFrame, shift: DataFrame, keys: list[str],
                 run_date: str, dag_id: str) -> DataFrame:
    """The consolidated report flattened to one row per (section, feature)."""
    common = [F.lit(run_date).alias("run_date"), F.lit(dag_id).alias("dag_id")]
    nd = F.lit(None).cast("double")
    nb = F.lit(None).cast("boolean")
    ns = F.lit(None).cast("string")
    p = psi.select(*keys, *common, F.lit("psi").alias("section"), "psi", "severity",
                   nd.alias("ks_statistic"), nd.alias("p_value"), nb.alias("drifted"),
                   nd.alias("baseline_mean"), nd.alias("current_mean"), nd.alias("mean_shift_pct"),
                   nd.alias("baseline_var"), nd.alias("current_var"), nd.alias("var_shift_pct"))
    k = ks.select(*keys, *common, F.lit("ks").alias("section"), nd.alias("psi"), ns.alias("severity"),
                  "ks_statistic", "p_value", "drifted",
                  nd.alias("baseline_mean"), nd.alias("current_mean"), nd.alias("mean_shift_pct"),
                  nd.alias("baseline_var"), nd.alias("current_var"), nd.alias("var_shift_pct"))
    s = shift.select(*keys, *common, F.lit("shift").alias("section"), nd.alias("psi"), ns.alias("severity"),
                     nd.alias("ks_statistic"), nd.alias("p_value"), nb.alias("drifted"),
                     "baseline_mean", "current_mean", "mean_shift_pct",
                     "baseline_var", "current_var", "var_shift_pct")
    return p.unionByName(k).unionByName(s)


def write_report_json(report: DataFrame, segments: list[str], path: str) -> None:
    """Nested report per segment ``{run_date, dag_id, psi[], ks[], shift[]}`` as JSON lines."""
    psi_cols = ["feature", "psi", "severity"]
    ks_cols = ["feature", "ks_statistic", "p_value", "drifted"]
    sh_cols = ["feature", "baseline_mean", "current_mean", "mean_shift_pct",
               "baseline_var", "current_var", "var_shift_pct"]

    def section(name, cols):
        return F.transform(
            F.array_sort(F.collect_list(F.when(F.col("section") == name,
                                               F.struct(F.col("feature_idx"), *[F.col(c) for c in cols])))),
            lambda x: F.struct(*[x[c].alias(c) for c in cols]))

    nested = report.groupBy(*segments, "run_date", "dag_id").agg(
        section("psi", psi_cols).alias("psi"), section("ks", ks_cols).alias("ks"),
        section("shift", sh_cols).alias("shift"))
    nested.write.mode("overwrite").json(path)


def _lookup(table: dict[str, str], key: Column, other: str) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), F.lit(other))


def severity_color(severity: Column) -> Column:
    return _lookup(SEVERITY_COLORS, severity, SEVERITY_COLORS["warning"])


def alert_payload(severity: Column, text: Column, fields: dict[str, Column] | None = None) -> Column:
    """The JSON body of an alert message: one attachment with colour, text and short fields."""
    parts = [severity_color(severity).alias("color"), text.alias("text"), F.array(F.lit("text")).alias("mrkdwn_in")]
    if fields:
        parts.append(F.array(*[F.struct(F.lit(t).alias("title"), v.cast("string").alias("value"), F.lit(True).alias("short"))
                               for t, v in fields.items()]).alias("fields"))
    return F.to_json(F.struct(F.array(F.struct(*parts)).alias("attachments")))


def drift_alert_payloads(alerts: DataFrame) -> DataFrame:
    """The message bodies of drift alerts, with their fields."""
    fields = {"Run Date": F.col("run_date"), "DAG": F.col("dag_id"), "Drifted Features": F.col("drifted_features"),
              "Should Retrain": F.col("should_retrain")}
    return alerts.withColumn("payload", alert_payload(F.col("severity"), F.col("message"), fields))


def retrain_notices(registry: DataFrame) -> DataFrame:
    """One notice per registry record: a retraining was triggered."""
    # fixed texts of the notice
    message = F.concat(F.lit("✅ *ML Retraining Triggered* — `"), F.col("dag_id"), F.lit("` | `"), F.col("retrain_date"),
                       F.lit("`\nNew model version: *"), F.col("model_version"),
                       F.lit("*\nDrift counters reset. Monitoring continues."))
    fields = {"Model Version": F.col("model_version"), "Trigger Date": F.col("retrain_date")}
    return registry.select(*[c for c in registry.columns if c in ("pipeline", "model_version", "retrain_date")],
                           F.lit("ok").alias("severity"), message.alias("message"),
                           alert_payload(F.lit("ok"), message, fields).alias("payload"))


def drift_alerts(verdicts: DataFrame, overall: DataFrame, segments: list[str],
                 run_date: str, dag_id: str) -> DataFrame:
    """Alert rows for the segments that should alert (the webhook post is not built:
    the alert table is the sink)."""
    keys = segments or ["_all"]
    if not segments:     # one verdict: join the two one-row tables on a constant key
        verdicts = verdicts.withColumn("_all", F.lit(1))
        overall = overall.withColumn("_all", F.lit(1))
    drifted = verdicts.where(F.col("status") != "ok").groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("feature_idx", "feature"))),
                                 lambda x: x["feature"]), ", ").alias("drifted_list"))
    o = overall.where(F.col("should_alert")).join(drifted, on=keys, how="left")
    status = F.col("overall_status")
    emoji, color = _lookup(SEVERITY_EMOJI, status, UNKNOWN_EMOJI), severity_color(status)
    message = F.concat(emoji, F.lit(f" {ALERT_TITLE} — `{dag_id}` | `{run_date}`\nStatus: *"),
                       F.upper(status), F.lit("*\n"), F.col("summary"))
    drifted_text = F.coalesce(F.nullif(F.col("drifted_list"), F.lit("")), F.lit("none"))
    return o.select(*segments, F.lit(run_date).alias("run_date"), F.lit(dag_id).alias("dag_id"),
                    status.alias("severity"), color.alias("color"), message.alias("message"),
                    drifted_text.alias("drifted_features"),
                    F.when(F.col("should_retrain"), "Yes").otherwise("No").alias("should_retrain"))
