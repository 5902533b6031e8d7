import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.operators.quality import (check_table, coerce_numeric, least_rows, may_be_empty, most_nulls, numeric, required,
                                         rules_of_schema, stop_on_errors)
from driftline.operators.retrain import model_registry, retrain_decisions
from driftline.session import scratch_path
from driftline.sources.files import (late_partitions, load_recent, load_snapshot, load_training, read_table, save_snapshot,
                                     save_snapshots, parse_events)
from driftline.sources.tables import event_payloads, inference_rows
from tests.conftest import SF_SMALL


def test_check_table_levels_and_messages(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, 2.0, "b"), (3.0, None, None), (4.0, None, "c")],
                               "score double, f3 double, s string")
    spec = [*least_rows(5), *required("score", "ts"), *numeric("score", "s"), *may_be_empty("f3"), *most_nulls(0.2)]
    rows = {(r["check"], r["column"]): r for r in check_table(df, spec).collect()}
    assert rows[("row_count", None)]["message"] == "Snapshot has 4 rows; minimum required is 5."
    assert rows[("required_columns", None)]["message"] == "Missing required columns: ['ts']"
    assert rows[("numeric_type", "s")]["level"] == "error"
    assert rows[("null_rate", "f3")]["message"] == "Nullable column 'f3' has a high null rate: 75.0%."
    assert rows[("null_rate", "score")]["message"] == "Column 'score' null rate 25.0% exceeds threshold 20.0%."
    assert rows[("null_rate", "s")]["level"] == "error"
    with pytest.raises(ValueError, match="snapshot checks failed"):
        stop_on_errors(check_table(df, spec))
    derived = rules_of_schema(df.schema)
    assert [r.column for r in derived if r.check == "numeric_type"] == ["score", "f3"]
    assert [r.limit for r in derived if r.check == "row_count"] == [10]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([(" 1.5 ", "x"), ("1.5d", "2"), ("-3e2", None)], "a string, b string")
    out = coerce_numeric(df, ["a", "b", "missing"]).collect()
    assert [r["a"] for r in out] == [1.5, None, -300.0]
    assert [r["b"] for r in out] == [None, 2.0, None]


def test_snapshots_recent_late_training(spark):
    rows = inference_rows(spark, SF_SMALL)
    root = scratch_path(spark, "snap-test")
    save_snapshots(rows.where(F.col("snapshot_date") != F.lit("2024-01-05").cast("date")), root)
    late = [r["run_date"] for r in late_partitions(spark.read.parquet(root), "2024-01-01", "2024-01-07").collect()]
    assert late == [dt.date(2024, 1, 5)]
    recent = load_recent(spark, root, "2024-01-07", 3)
    assert {r[0] for r in recent.select("_snapshot_date").distinct().collect()} == {"2024-01-06", "2024-01-07"}
    with pytest.raises(FileNotFoundError):
        load_recent(spark, root, "2023-01-07", 3)
    with pytest.raises(FileNotFoundError):
        load_snapshot(spark, root, "2024-01-05")
    # the format that comes first is read for each day
    mixed = scratch_path(spark, "snap-csv")
    save_snapshots(rows.where("snapshot_date BETWEEN '2024-01-05' AND '2024-01-06'"), mixed, "csv")
    both = {"csv": mixed, "parquet": root}
    assert load_snapshot(spark, both, "2024-01-05", schema=rows.schema).count() > 0
    parts = load_recent(spark, both, "2024-01-07", 3, schema=rows.schema)
    assert parts.groupBy("_snapshot_date").count().count() == 3 and parts.count() == rows.where("snapshot_date BETWEEN '2024-01-05' AND '2024-01-07'").count()
    # re-saving a day replaces only that day
    one = rows.where(F.col("snapshot_date") == F.lit("2024-01-06").cast("date")).limit(3).drop("snapshot_date")
    save_snapshot(one, root, "2024-01-06")
    assert spark.read.parquet(root).where("snapshot_date = '2024-01-06'").count() == 3
    assert spark.read.parquet(root).where("snapshot_date = '2024-01-07'").count() > 3
    with pytest.raises(ValueError):
        save_snapshot(one, root, "2024-01-06", fmt="orc")
    with pytest.raises(ValueError):
        read_table(spark, "/nowhere/file.xlsx")
    with pytest.raises(ValueError):
        load_training(spark, {}, "2024-01-07")


def test_parse_events_quarantine(spark):
    payloads = event_payloads(spark, SF_SMALL).limit(5)
    bad = spark.createDataFrame([(-1, '{"model": "m"}'), (-2, "not json"),
                                 (-3, '{"model": "m", "features": {"a": 1.0}, "timestamp": 0}')],
                                "event_id long, payload string")
    parsed = parse_events(payloads.unionByName(bad))
    got = {r["event_id"]: r for r in parsed.collect()}
    assert all(got[i]["valid"] for i in got if i >= 0)
    assert not got[-1]["valid"] and not got[-2]["valid"] and got[-3]["valid"]
    assert got[-3]["ts"] is not None      # zero timestamp -> arrival time


def test_retrain_counter_semantics(spark):
    statuses = ["critical", "ok", "critical", "warning", "critical", "critical", "ok", "critical", "critical"]
    runs = spark.createDataFrame(
        [("p", dt.date(2024, 1, 1) + dt.timedelta(days=i), s) for i, s in enumerate(statuses)],
        "pipeline string, run_date date, overall_status string")
    d = retrain_decisions(runs).orderBy("run_date").collect()
    assert [r["consecutive_count"] for r in d] == [1, 1, 2, 2, 3, 1, 1, 2, 3]
    assert [r["retrain_triggered"] for r in d] == [False] * 4 + [True, False, False, False, True]
    assert [r["counter_after"] for r in d][4] == 0
    # outside the allowed hours the request stays open and nothing is triggered
    d2 = retrain_decisions(runs, check_hour=20).orderBy("run_date").collect()
    assert not any(r["retrain_triggered"] for r in d2) and d2[-1]["consecutive_count"] == 6
    reg = model_registry(retrain_decisions(runs)).collect()
    assert len(reg) == 2 and reg[0]["model_version"].startswith("v_2024010")
    assert reg[0]["consecutive_drift_runs"] == 3 and len(reg[0]["run_id"]) == 10


def test_json_document_and_extension_case(spark, tmp_path):
    import json
    path = str(tmp_path / "day.JSON")
    with open(path, "w") as f:
        json.dump([{"a": 1.5, "b": "x"}, {"a": 2.5, "b": None}], f)
    df = read_table(spark, path, json_document=True)
    assert sorted(r["a"] for r in df.collect()) == [1.5, 2.5]


def test_manifest_decides_what_is_there(spark, monkeypatch):
    """Availability, format and columns come from the manifest: no data file is opened for them."""
    from driftline.plans.jobs import late_days
    from driftline.sources import files
    rows = inference_rows(spark, SF_SMALL)
    root = scratch_path(spark, "manifest")
    save_snapshots(rows.where("snapshot_date BETWEEN '2024-01-01' AND '2024-01-04'"), root)
    save_snapshot(rows.where("snapshot_date = '2024-01-02'").drop("snapshot_date", "feature_2").withColumn("extra", F.lit(1)), root, "2024-01-02")
    m = {str(r["snapshot_date"]): r for r in files.read_manifest(spark, root).collect()}
    assert sorted(m) == [f"2024-01-0{d}" for d in range(1, 5)] and all(r["format"] == "parquet" for r in m.values())
    assert sum(r["rows"] for r in m.values()) == rows.where("snapshot_date BETWEEN '2024-01-01' AND '2024-01-04'").count()
    monkeypatch.setattr(files, "days_in", lambda *a: pytest.fail("listed"))
    united = load_recent(spark, root, "2024-01-04", 4)
    assert {"extra", "feature_2"} <= set(united.columns) and united.count() == sum(r["rows"] for r in m.values())
    assert [str(r["run_date"]) for r in late_days(spark, root, "2024-01-03", "2024-01-06").orderBy("run_date").collect()] == ["2024-01-05", "2024-01-06"]
    plan = late_days(spark, root, "2024-01-03", "2024-01-06")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan  # of the manifest: its partition column alone
