"""Session settings and the shared folder used for tables and checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from quotelake.package import ship

# The session time zone decides trade_date and window bounds, so it is pinned.
# Duplicate JSON keys keep the last value, as JSON readers commonly do.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The older form of timestamps has no bounds in Parquet, so time filters would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Counts of rows come from file footers where a table is read through the newer interface.
    "spark.sql.parquet.aggregatePushdown": "true",
    # Stored documents unpack to about ten times their bytes, twice that with their parsed fields:
    # a task that reads so much still holds its rows in memory and spills nothing.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on, and give the package to Python workers;
    cluster sizing is left alone."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster
    session without it is refused, since executors could not read each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="quotelake-")
    spark.sparkContext.setCheckpointDir(own)
    return own
