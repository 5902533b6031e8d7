"""File sources and sinks: tables by extension, date-partitioned snapshots,
recent-window and training-window reads, late partitions, event intake."""

from __future__ import annotations

import json
import logging
import os
import uuid
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

log = logging.getLogger(__name__)

SNAPSHOT_COL = "snapshot_date"
TAG_COL = "_snapshot_date"
# Snapshot file formats in order of precedence, and the defaults of
# the recent (7 days) and training (90 days, no JSON) windows.
SNAPSHOT_FORMATS = ("parquet", "csv", "json")
TRAINING_FORMATS = ("parquet", "csv")
SAVE_FORMATS = ("parquet", "csv")
RECENT_DAYS = 7
# CSV keeps timestamps to the microsecond (the writer's default stops at milliseconds)
CSV_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
TRAINING_DAYS = 90
MANIFEST = "_manifest"   # below a snapshot folder: a row per day (format, rows, schema)
STAGING = "_staging"
REJECTED = "_rejected"
MANIFEST_SCHEMA = f"format string, rows long, schema string, {SNAPSHOT_COL} date"


def _reader(spark: SparkSession, fmt: str, schema=None, json_document: bool = False):
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true").options(**CSV_TS)
        if schema is None:
            r = r.option("inferSchema", "true")
    elif fmt == "json" and json_document:
        r = r.option("multiLine", "true")   # one document holding an array of records
    return r


def read_table(spark: SparkSession, path: str, schema=None, json_document: bool = False) -> DataFrame:
    """Read ``.parquet`` / ``.csv`` / ``.json`` by extension (case-insensitive).

    JSON is read as JSON Lines (what Spark writes); ``json_document=True`` reads a
    file holding one array of records.  Pass ``schema`` to skip inference."""
    ext = os.path.splitext(path)[1].lower().lstrip(".")
    if ext not in SNAPSHOT_FORMATS:
        raise ValueError(f"cannot read '{path}': use one of {', '.join(SNAPSHOT_FORMATS)}")
    return _reader(spark, ext, schema, json_document).load(path)


def write_table(df: DataFrame, path: str, fmt: str) -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", "true").options(**CSV_TS)
    w.format(fmt).save(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    try:
        df = read_table(spark, path)
        df.schema  # noqa: B018  (resolves the path)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"there is no baseline at '{path}'") from e
        raise


# -- date-partitioned snapshots -------------------------------------------------
def overwrite_partitions(df: DataFrame, path: str, fmt: str, *columns: str) -> None:
    """Write by ``columns``; only the partitions that are present are replaced."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns)
    if fmt == "csv":
        w = w.option("header", "true").options(**CSV_TS)
    w.format(fmt).save(path)


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def days_in(spark: SparkSession, root: str) -> list[str]:
    """The days that have a folder: one listing, no data."""
    fs, target = _folder(spark, root)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{SNAPSHOT_COL}="))


def stage_snapshots(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Write rows by day into a new staging folder, in one pass over ``df``."""
    if fmt not in SAVE_FORMATS:
        raise ValueError(f"snapshots are saved as {' or '.join(SAVE_FORMATS)}, not as {fmt}")
    staging = f"{root}/{STAGING}/{uuid.uuid4().hex[:12]}"
    # few files per day; a large day is split over several tasks
    overwrite_partitions(df.hint("rebalance", F.col(SNAPSHOT_COL)), staging, fmt, SNAPSHOT_COL)
    return staging


def promote(spark: SparkSession, staging: str, root: str, days: list[str]) -> None:
    """Move staged days to their place by renaming; each replaces that day only."""
    for day in days:
        fs, source = _folder(spark, f"{staging}/{SNAPSHOT_COL}={day}")
        _, target = _folder(spark, f"{root}/{SNAPSHOT_COL}={day}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"the snapshot of {day} could not be moved into {root}")


def record_days(spark: SparkSession, root: str, fmt: str, rows: dict[str, int], schema: StructType) -> None:
    """Put days into the manifest; a day's row replaces the one before."""
    if rows:
        kind = StructType([f for f in schema.fields if f.name != SNAPSHOT_COL]).json()
        made = spark.createDataFrame([(fmt, n, kind, date.fromisoformat(day)) for day, n in rows.items()], MANIFEST_SCHEMA)
        overwrite_partitions(made.coalesce(1), f"{root}/{MANIFEST}", "parquet", SNAPSHOT_COL)


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """(format, rows, schema, snapshot_date), or None where none is kept."""
    fs, target = _folder(spark, f"{root}/{MANIFEST}")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{MANIFEST}") if fs.exists(target) else None


def _drop(spark: SparkSession, path: str) -> None:
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def save_snapshots(df: DataFrame, root: str, fmt: str = "parquet", date_col: str = SNAPSHOT_COL) -> None:
    """Write rows partitioned by date; only the dates present are replaced, so re-running a
    day overwrites that day.  The manifest gets their rows and columns."""
    spark, df = df.sparkSession, df.withColumnRenamed(date_col, SNAPSHOT_COL)
    staging = stage_snapshots(df, root, fmt)
    counts = _reader(spark, fmt, df.schema).load(staging).groupBy(SNAPSHOT_COL).count().collect()  # a row per day
    rows = {str(r[SNAPSHOT_COL]): r["count"] for r in counts}
    promote(spark, staging, root, sorted(rows))
    record_days(spark, root, fmt, rows, df.schema)
    _drop(spark, staging)


def save_snapshot(df: DataFrame, root: str, run_date: str, fmt: str = "parquet") -> None:
    save_snapshots(df.withColumn(SNAPSHOT_COL, F.lit(run_date).cast("date")), root, fmt)


def read_snapshots(spark: SparkSession, root: str, fmt: str = "parquet", schema=None) -> DataFrame:
    return _reader(spark, fmt, schema).load(root)


def _known(spark: SparkSession, root: str, days: list[str]) -> dict[str, str | None]:
    """Of the given days those that are there, with their columns (as JSON) where a manifest
    tells; without one, by one listing."""
    manifest = read_manifest(spark, root)
    if manifest is None:
        there = set(days_in(spark, root))
        return {d: None for d in days if d in there}
    wanted = F.col(SNAPSHOT_COL).isin([date.fromisoformat(d) for d in days])
    return {str(r[SNAPSHOT_COL]): r["schema"] for r in manifest.where(wanted).select(SNAPSHOT_COL, "schema").collect()}


def _days(spark: SparkSession, root: str | dict[str, str], days: list[str], formats: tuple[str, ...], fmt: str,
          schema=None) -> DataFrame | None:
    """The given days, each from the first format that has it, united by column name.

    What is there and which columns it has is read from the manifest, so nothing grows with
    the history, and no file is opened for it.  Days that are missing everywhere are logged."""
    roots = root if isinstance(root, dict) else {fmt: root}
    usable = [f for f in (formats if isinstance(root, dict) else (fmt,)) if f in roots]
    known = {f: _known(spark, roots[f], days) for f in usable}
    found: dict[tuple[str, str | None], list[str]] = {}   # days of one format and one set of columns
    for day in days:
        f = next((f for f in usable if day in known[f]), None)
        if f is None:
            log.warning("no snapshot of %s", day)
        else:
            found.setdefault((f, known[f][day]), []).append(f"{roots[f]}/{SNAPSHOT_COL}={day}")
    out = None
    for (f, columns), paths in found.items():
        kind = StructType.fromJson(json.loads(columns)) if columns else schema if f != "parquet" else None
        reader = _reader(spark, f, kind).option("basePath", roots[f])
        if f == "parquet" and columns is None:
            reader = reader.option("mergeSchema", "true")  # of these days only
        part = reader.load(paths)
        part = part.withColumn(SNAPSHOT_COL, F.col(SNAPSHOT_COL).cast("date"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _last_days(run_date: str, n_days: int) -> list[str]:
    end = date.fromisoformat(run_date)
    return [(end - timedelta(days=k)).isoformat() for k in range(n_days)]


def _tagged(df: DataFrame) -> DataFrame:
    return df.withColumn(TAG_COL, F.date_format(SNAPSHOT_COL, "yyyy-MM-dd"))


def load_snapshot(spark: SparkSession, root: str | dict[str, str], run_date: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """One day, from its own folder.  ``root`` may name a folder per format; then parquet
    comes before csv and csv before json.  A missing day is an error."""
    out = _days(spark, root, [run_date], SNAPSHOT_FORMATS, fmt, schema)
    if out is None:
        raise FileNotFoundError(f"there is no snapshot of {run_date}")
    return out


def load_recent(spark: SparkSession, root: str | dict[str, str], run_date: str, n_days: int = RECENT_DAYS,
                fmt: str = "parquet", schema=None) -> DataFrame:
    """Last ``n_days`` days ending at ``run_date`` (inclusive), tagged with the day.
    Missing days are logged; if none is there, that is an error."""
    out = _days(spark, root, _last_days(run_date, n_days), SNAPSHOT_FORMATS, fmt, schema)
    if out is None:
        raise FileNotFoundError(f"there is no snapshot of the {n_days} days up to {run_date}")
    return _tagged(out)


def load_training(spark: SparkSession, roots: dict[str, str], run_date: str,
                  n_days: int = TRAINING_DAYS, schema=None) -> DataFrame:
    """Training window: for each day the parquet snapshot, else the CSV one (JSON
    is not used here); union by name, missing columns filled with NULL."""
    usable = {f: r for f, r in roots.items() if f in TRAINING_FORMATS}
    out = _days(spark, usable, _last_days(run_date, n_days), TRAINING_FORMATS, "parquet", schema)
    if out is None:
        raise ValueError("no snapshots to train on")
    return _tagged(out)


def present_days(spark: SparkSession, root: str) -> DataFrame:
    """The days of a snapshot folder, from its manifest or one listing; no data is read."""
    manifest = read_manifest(spark, root)
    if manifest is not None:
        return manifest.select(SNAPSHOT_COL)
    return spark.createDataFrame([(date.fromisoformat(d),) for d in days_in(spark, root)], f"{SNAPSHOT_COL} date")


def load_raw(spark: SparkSession, folder: str, run_date: str, schema=None) -> DataFrame:
    """The raw log of one day, from the first of ``<day>.parquet``, ``.csv`` and ``.json``."""
    for fmt in SNAPSHOT_FORMATS:
        fs, target = _folder(spark, f"{folder}/{run_date}.{fmt}")
        if fs.exists(target):
            return read_table(spark, f"{folder}/{run_date}.{fmt}", schema if fmt != "parquet" else None)
    raise FileNotFoundError(f"there is no raw log of {run_date}")


def late_partitions(available_dates: DataFrame, start: str, end: str) -> DataFrame:
    """Expected days in [start, end] minus the days present -> the late days."""
    spark = available_dates.sparkSession
    expected = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias(SNAPSHOT_COL))
    have = available_dates.select(SNAPSHOT_COL).distinct()
    late = expected.join(have, on=SNAPSHOT_COL, how="left_anti")
    return late.select(F.col(SNAPSHOT_COL).alias("run_date"), F.lit("late").alias("status"))


# -- event intake ---------------------------------------------------------------
EVENT_SCHEMA = StructType([
    StructField("model", StringType()),
    StructField("timestamp", DoubleType()),
    StructField("features", MapType(StringType(), DoubleType())),
    StructField("prediction", DoubleType()),
    StructField("metadata", MapType(StringType(), StringType())),
])


def parse_events(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """JSON request bodies -> typed events.  ``model`` and ``features`` are required;
    a missing or zero timestamp becomes the arrival time; rows that fail (malformed,
    missing fields, non-numeric features) are kept with ``valid = false`` and the ``reason``
    for a quarantine table instead of failing the job.  ``metadata`` is not kept."""
    p = F.from_json(F.col(col), EVENT_SCHEMA, {"mode": "PERMISSIVE"})
    # a feature that is no number leaves the whole map empty-handed in some readers: told by the text;
    # the text is found only if all of the body could be read, which then need not be read once more
    parsed = payloads.withColumns({"_p": p, "_text": F.get_json_object(col, "$.features")})
    ts_sec = F.coalesce(F.nullif(F.col("_p.timestamp"), F.lit(0.0)),
                        F.unix_micros(F.current_timestamp()).cast("double") / F.lit(1e6))
    numbers = F.coalesce(F.forall(F.map_values(F.col("_p.features")), lambda v: v.isNotNull()), F.lit(False))
    unread = F.when(F.col("_text").isNull(), F.get_json_object(col, "$").isNull()).otherwise(F.lit(False))
    reason = (F.when(F.col("_p").isNull() | unread, "not a JSON object")
              .when(F.col("_p.model").isNull(), "no model")
              .when(F.col("_text").isNull(), "no features")
              .when(F.col("_p.features").isNull() | ~numbers, "a feature is not a number"))
    keep = [c for c in payloads.columns if c != col]
    return parsed.select(
        *keep,
        F.col("_p.model").alias("model"),
        F.timestamp_micros(F.round(ts_sec * F.lit(1e6)).cast("long")).cast("timestamp_ntz").alias("ts"),
        F.col("_p.features").alias("features"),
        F.col("_p.prediction").alias("prediction"),
        reason.isNull().alias("valid"), reason.alias("reason"))
