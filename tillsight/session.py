"""A session with the settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Recommended settings; every one is a public Spark option and may be overridden.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commit what changed in a micro-batch, not a snapshot of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app: str = "tillsight", **extra: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        b = b.config(key, value)
    return b
