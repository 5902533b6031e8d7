"""Stored signals and predictions: written once per session, input and variant, read many times.

Rows are partitioned by day and, within a day, sorted by model, so a read of one model
or of the latest rows skips files and row groups by their statistics.  The reads below
never run the signal engine; they scan these tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.scoring import predictions
from driftline.operators.signals import compute_signals, explode_features, signal_rows
from driftline.session import scratch_path
from driftline.sources.tables import event_stream

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _write(df: DataFrame, path: str) -> None:
    (df.withColumn("day", F.to_date("ts")).repartitionByRange("day", "model", "event_id")
     .sortWithinPartitions("day", "model", "event_id").write.partitionBy("day").parquet(path))


def store(spark: SparkSession, sf_dir: str, variant: str = "warm") -> str:
    """The folder of the stored tables, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, variant)
    if key not in _WRITTEN:
        base = scratch_path(spark, f"stored-{variant}")
        rows = compute_signals(explode_features(event_stream(spark, sf_dir, variant), keep_empty=True))
        rows.write.parquet(os.path.join(base, "rows"))
        rows = spark.read.parquet(os.path.join(base, "rows"))
        _write(signal_rows(rows), os.path.join(base, "signals"))
        _write(predictions(rows), os.path.join(base, "predictions"))
        _WRITTEN[key] = base
    return _WRITTEN[key]


def signals(spark: SparkSession, sf_dir: str, variant: str = "warm") -> DataFrame:
    return spark.read.parquet(os.path.join(store(spark, sf_dir, variant), "signals")).drop("day")


def scored(spark: SparkSession, sf_dir: str, variant: str = "warm") -> DataFrame:
    return spark.read.parquet(os.path.join(store(spark, sf_dir, variant), "predictions")).drop("day")
