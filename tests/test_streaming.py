import os

from pyspark.sql import functions as F

from driftline.operators.signals import compute_signals, explode_features, signal_rows
from driftline.session import scratch_path
from driftline.sources.tables import event_stream, table
from driftline.streaming.live import read_output, read_outputs, run_live, signals_table
from tests.conftest import SF_SMALL


def _batch_signals(spark):
    return {tuple(r) for r in signal_rows(compute_signals(explode_features(event_stream(spark, SF_SMALL))))
            .select("event_id", "feature", "drift", "velocity", "acceleration", "samples").collect()}


def test_stream_in_several_batches_with_restart(spark):
    ev = table(spark, SF_SMALL, "events")
    base = scratch_path(spark, "stream-test")
    src = os.path.join(base, "src")
    days = sorted(r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().collect())
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    # first run: the first half of the days, one file per day, 4 files per micro-batch
    for d in days[:15]:
        ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("append").parquet(src)
    made = [run_live(spark, src, out, ckpt, max_files_per_trigger=4, schema=ev.schema)]
    # restart from the checkpoint after more days arrived: state must carry over
    for d in days[15:]:
        ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("append").parquet(src)
    made.append(run_live(spark, src, out, ckpt, max_files_per_trigger=4, schema=ev.schema))
    rows, pred = read_outputs(spark, out)
    got = {tuple(r) for r in signals_table(rows)
           .select("event_id", "feature", "drift", "velocity", "acceleration", "samples").collect()}
    assert got == _batch_signals(spark)
    assert pred.count() == ev.count()
    events = read_output(spark, out, "events")
    assert events.count() == ev.count() and events.first()["features"].keys() == {"f1", "f2", "f3"}
    assert sum(r["input_rows"] for r in made) == ev.count()  # each file is read once
    assert len([d for d in os.listdir(os.path.join(out, "signal_rows").removeprefix("file:")) if d.startswith("batch=")]) > 2


def test_event_without_features_is_unknown(spark):
    from driftline.operators.scoring import predictions
    from driftline.streaming.processor import KeySignals
    events = spark.createDataFrame([(1, "m", {"a": 1.0}), (2, "m", {}), (3, "m", None), (4, "m", {"a": float("nan")})],
                                   "event_id long, model string, features map<string,double>") \
        .withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = explode_features(events, keep_empty=True)
    assert sorted(r["event_id"] for r in rows.where("feature = ''").collect()) == [2, 3, 4]
    flat = rows.withColumn("t", F.lit(0).cast("long")).withColumns(
        {c: F.lit(None).cast("double") for c in ("drift", "velocity", "acceleration")}).withColumn("samples", F.lit(None).cast("long"))
    assert {r["event_id"]: r["risk"] for r in predictions(flat).collect()} == {k: "UNKNOWN" for k in (1, 2, 3, 4)}
    assert KeySignals().feed(1.0) is None


def test_stored_reads_scan_files_only(spark):
    from driftline.plans.signal_queries import QUERIES
    for name in ("signals_recent", "signals_recent_model", "prediction_history", "latest_predictions", "recent_trajectory", "pipeline_metrics"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "ExistingRDD" not in plan and "Join" not in plan, name
    plan = QUERIES["signals_recent_model"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(model,7)" in plan


def test_batch_then_stream_and_half_written_batches(spark, monkeypatch):
    """A stream that starts from a batch scan's state; a crash between two tables of a batch."""
    import pytest

    from driftline.operators.signals import key_state
    from driftline.streaming import live
    ev = table(spark, SF_SMALL, "events")
    split = F.col("ts") < F.lit("2024-01-14").cast("timestamp_ntz")
    early = explode_features(event_stream(spark, SF_SMALL).where(split), keep_empty=True)
    base = scratch_path(spark, "batch-then-stream")
    src, out, ckpt, kept = (os.path.join(base, n) for n in ("src", "out", "ckpt", "state"))
    key_state(compute_signals(early, keep_state=True)).write.parquet(kept)
    ev.where(~split & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))).coalesce(1).write.mode("append").parquet(src)
    ev.where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src)
    state = spark.read.parquet(kept)
    write = live.write_table

    def failing(df, folder, name, batch_id):
        if batch_id == 1 and name == "predictions":
            raise RuntimeError("lost")
        write(df, folder, name, batch_id)

    monkeypatch.setattr(live, "write_table", failing)
    with pytest.raises(Exception, match="lost"):
        run_live(spark, src, out, ckpt, max_files_per_trigger=1, schema=ev.schema, state=state)
    first = read_output(spark, out, "signal_rows").count()
    assert first == 3 * read_output(spark, out, "events").count() < spark.read.parquet(os.path.join(out, "signal_rows")).count()
    monkeypatch.setattr(live, "write_table", write)
    run_live(spark, src, out, ckpt, max_files_per_trigger=1, schema=ev.schema, state=state)
    late_ids = {r[0] for r in ev.where(~split).select("event_id").collect()}
    got = {tuple(r) for r in signals_table(read_outputs(spark, out)[0])
           .select("event_id", "feature", "drift", "velocity", "acceleration", "samples").collect()}
    assert got == {r for r in _batch_signals(spark) if r[0] in late_ids}
    assert read_output(spark, out, "predictions").count() == len(late_ids)


def test_days_one_by_one(spark):
    from driftline.plans import daily
    root = scratch_path(spark, "daily-test")
    ev = event_stream(spark, SF_SMALL).where(F.col("ts") < F.lit("2024-01-07").cast("timestamp_ntz"))
    days = [f"2024-01-0{d}" for d in range(1, 7)]
    for d in [*days, days[-1]]:  # the last one twice: replaced
        daily.run_span(spark, ev, root, d, d)
    cols = ["event_id", "feature", "drift", "velocity", "acceleration", "samples"]
    want = signal_rows(compute_signals(explode_features(ev)))
    assert sorted(tuple(r) for r in daily.signals(spark, root).select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    assert daily.scored(spark, root).count() == ev.count()
