import os

import pytest
from pyspark.sql import functions as F

from driftline.plans.ingest_queries import INGEST_RULES
from driftline.plans.jobs import ingest_day, ingest_snapshots, plan_retraining, run_drift_monitor
from driftline.session import scratch_path
from driftline.sources.tables import inference_rows
from tests.conftest import SF_SMALL


def test_ingest_monitor_retrain_end_to_end(spark):
    base = scratch_path(spark, "jobs")
    root = os.path.join(base, "snapshots")
    raw = inference_rows(spark, SF_SMALL).where(F.col("snapshot_date") != F.lit("2024-01-12").cast("date"))
    summary, late = ingest_snapshots(raw, root, INGEST_RULES, "2024-01-01", "2024-01-31")
    assert {str(r["run_date"]) for r in late.collect()} == {"2024-01-12", "2024-01-31"}
    assert summary.where("passed").count() == 29
    baseline = spark.read.parquet(root).where("snapshot_date < '2024-01-08'").drop("snapshot_date")
    res = run_drift_monitor(spark, baseline, root, "2024-01-20", os.path.join(base, "results"))
    feats = {r["feature"] for r in res.psi.collect()}
    assert {"prediction_score", "feature_1", "feature_2", "feature_3"} <= feats
    assert spark.read.parquet(os.path.join(base, "results", "psi")).where("run_date = '2024-01-20'").count() == len(feats)
    assert spark.read.json(os.path.join(base, "results", "report")).count() == 1
    path = os.path.join(base, "baseline.parquet")
    baseline.write.parquet(path)
    run_drift_monitor(spark, path, root, "2024-01-20", os.path.join(base, "results"))  # a rerun replaces the day
    at = spark.read.parquet(os.path.join(base, "results", "verdicts")).first()["evaluated_at"]
    assert str(at) == "2024-01-20 06:00:00"  # not the hour of the backfill
    with pytest.raises(FileNotFoundError):
        run_drift_monitor(spark, path + "x.parquet", root, "2024-01-20", os.path.join(base, "results"))
    for name in ("psi", "verdicts"):
        again = spark.read.parquet(os.path.join(base, "results", name)).where("run_date = '2024-01-20'").count()
        assert again == (len(feats) if name == "psi" else 1)
    hist = spark.createDataFrame(
        [("a", f"2024-01-{d:02d}", "ok") for d in range(1, 4)] + [("b", f"2024-01-{d:02d}", "critical") for d in range(1, 4)],
        "pipeline string, run_date string, overall_status string").withColumn("run_date", F.to_date("run_date"))
    a, b = plan_retraining(spark, hist, {"parquet": root}, "2024-01-03", os.path.join(base, "retrain"))
    assert not a["retrain_triggered"] and b["retrain_triggered"] and b["consecutive_drift_runs"] == 3
    assert spark.read.parquet(b["dataset"]).count() > 0
    _, again = plan_retraining(spark, hist, {"parquet": root}, "2024-01-03", os.path.join(base, "retrain"))
    kept = spark.read.json(os.path.join(base, "retrain", "model_registry")).collect()
    assert [r["model_version"] for r in kept] == [b["model_version"]] == [again["model_version"]]  # a rerun keeps one record
    notice = spark.read.json(os.path.join(base, "retrain", "notices")).collect()
    assert len(notice) == 1 and b["model_version"] in notice[0]["payload"]
    assert not any(x["retrain_triggered"] for x in plan_retraining(spark, hist, {"parquet": root}, "2024-01-02", os.path.join(base, "retrain")))


def test_no_shared_feature_is_ok(spark):
    from driftline.plans.monitor import monitor_drift
    left, right = spark.createDataFrame([(1.0,)], "a double"), spark.createDataFrame([(1.0,)], "b double")
    row = monitor_drift(left, right).overall.collect()[0]
    assert (row["overall_status"], row["n_drifted"], row["n_features"]) == ("ok", 0, 1)


def test_ingestion_stops_on_failing_days_after_saving_the_others(spark):
    base = scratch_path(spark, "stopping")
    root = os.path.join(base, "snapshots")
    raw = inference_rows(spark, SF_SMALL).where("snapshot_date BETWEEN '2024-01-01' AND '2024-01-03'")
    bad = raw.withColumn("prediction_score", F.when(F.col("snapshot_date") != F.lit("2024-01-02").cast("date"), F.col("prediction_score")))
    with pytest.raises(ValueError, match="2024-01-02 Column 'prediction_score' null rate 100.0%"):
        ingest_snapshots(bad, root, INGEST_RULES, "2024-01-01", "2024-01-03", stop=True)
    assert {str(r[0]) for r in spark.read.parquet(root).select("snapshot_date").distinct().collect()} == {"2024-01-01", "2024-01-03"}
    assert spark.read.parquet(os.path.join(root, "_rejected")).count() > 0
    # one day from its raw log, in the first format there is
    logs = os.path.join(base, "logs")
    raw.where("snapshot_date = '2024-01-02'").drop("snapshot_date").write.json(os.path.join(logs, "2024-01-02.json"))
    raw.where("snapshot_date = '2024-01-02'").drop("snapshot_date").limit(12).write.parquet(os.path.join(logs, "2024-01-02.parquet"))
    assert ingest_day(spark, logs, root, INGEST_RULES, "2024-01-02") == "saved"
    assert ingest_day(spark, logs, root, INGEST_RULES, "2024-01-09") == "late"
    assert spark.read.parquet(root).where("snapshot_date = '2024-01-02'").count() == 12


def test_raw_rows_are_read_once(spark):
    raw = inference_rows(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = raw.mapInArrow(count, raw.schema)
    ingest_snapshots(counted, os.path.join(scratch_path(spark, "once"), "s"), INGEST_RULES, "2024-01-01", "2024-01-31")
    assert seen.value == raw.count()


def test_correlation_of_features(spark):
    from driftline.operators.extras import feature_correlation
    rows = [(i, "m", {"a": float(i), "b": 2.0 * i, "c": float(-i), "d": None if i % 2 else float(i * i)}) for i in range(10)]
    ev = spark.createDataFrame(rows, "event_id long, model string, features map<string,double>")
    got = {(r["feature_a"], r["feature_b"]): (r["n"], r["correlation"]) for r in feature_correlation(ev).collect()}
    assert got["a", "b"] == (10, 1.0) and got["a", "c"] == (10, -1.0) and got["a", "d"][0] == 5 and len(got) == 6
    with pytest.raises(Exception, match="more than 3 features"):
        feature_correlation(ev, most_features=3).collect()
