"""Session helpers: one place for the configuration every job relies on.

Nothing here starts a server: the Spark UI stays off.  The checkpoint folder
is read from the session (``spark.checkpoint.dir``).  A private one is set only if
the session has none and runs on one machine; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "driftline", extra: dict | None = None) -> SparkSession:
    """Local / test session.  On a cluster the submitter's session is used as is."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a private one only if unset."""
    cur = spark.sparkContext.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="driftline-ckpt-")  # one machine: tests and local runs
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder, below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "driftline", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table; on a cluster it is in shared storage."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def release_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete one scratch folder, or all of this application's, once nothing reads them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or scratch_root(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
