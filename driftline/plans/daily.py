"""Signals day by day: each span of days reads its own events and the state before it.

Below a root folder, per span (named by its last day): ``rows`` (signal rows, seeds included),
``predictions`` and ``state`` (one row per (model, feature)).  A span starts from the state of
the last span before it, never from older events; running it again replaces it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.scoring import predictions
from driftline.operators.signals import compute_signals, explode_features, key_state, signal_rows
from driftline.sources.files import _folder


def _spans(spark: SparkSession, root: str) -> list[str]:
    fs, target = _folder(spark, os.path.join(root, "state"))
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName().split("=")[1] for s in fs.listStatus(target) if "=" in s.getPath().getName())


def _put(df: DataFrame, root: str, table: str, span: str) -> DataFrame:
    path = os.path.join(root, table, f"span={span}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_span(spark: SparkSession, events: DataFrame, root: str, first: str, last: str) -> None:
    """Signals, predictions and state of the days from ``first`` to ``last``."""
    done = [s for s in _spans(spark, root) if s < first]
    before = spark.read.parquet(os.path.join(root, "state", f"span={done[-1]}")) if done else None
    mine = events.where((F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
                        & (F.col("ts") < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")))
    rows = _put(compute_signals(explode_features(mine, keep_empty=True), keep_state=True, state=before), root, "rows", last)
    _put(predictions(rows), root, "predictions", last)
    _put(key_state(rows, before), root, "state", last)


def signals(spark: SparkSession, root: str) -> DataFrame:
    return signal_rows(spark.read.parquet(os.path.join(root, "rows")).drop("span"))


def scored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, "predictions")).drop("span")


def state(spark: SparkSession, root: str) -> DataFrame:
    """The latest state of every key."""
    return spark.read.parquet(os.path.join(root, "state", f"span={_spans(spark, root)[-1]}"))
