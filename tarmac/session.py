"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tarmac job relies on. Time zone UTC makes clock-text parsing
# and epoch arithmetic independent of the machine; AQE re-plans joins and
# shuffle sizes from runtime statistics (broadcast conversion, partition
# coalescing, skew splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "tarmac",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the tarmac defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests;
    on a cluster both come from the submit configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor.
        conf["spark.driver.memory"] = os.environ.get("TARMAC_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Clock texts carry no zone; tarmac reads them as UTC wall-clock times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The cluster's value always wins. Only on a ``local`` master (local runs
    and tests) may it be unset: a fresh local folder is created and
    registered. On a cluster each executor would write such a folder on a
    disk of its own, so there an unset value is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tarmac-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local
