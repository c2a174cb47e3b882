"""Spark session settings used by every plan in the package.

The engine relies on Catalyst + AQE rather than hand scheduling:
adaptive execution re-plans joins with runtime sizes (broadcast only when
the measured side is under ``autoBroadcastJoinThreshold``), coalesces
small shuffle partitions and splits skewed join partitions.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every daymart plan expects (UTC wall clock, ANSI casts, AQE).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings and make sure a checkpoint dir exists.

    ``spark.checkpoint.dir`` names the cluster's shared folder; it is only
    filled in here when the session has none (local runs and tests).
    """
    for key, value in CORE_CONF.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    share_package(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver did (installed or mounted alike on all nodes)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to the cluster's shared folder")
        configured = tempfile.mkdtemp(prefix="daymart-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def get_spark(master: str | None = None, app: str = "daymart",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session; tests and bench use ``local[N]``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("DAYMART_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
