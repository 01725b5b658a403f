"""Session settings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # few partition values in a task are written side by side, without sorting (and spilling) its rows
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# Event state kept on disk by the executors instead of on the heap
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming queries that start inside keep their state on disk; the setting before comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def get_session(app: str = "terrace", fmt: str = "parquet") -> tuple[SparkSession, str]:
    """Reuse the platform's session or create one; returns it with the table format.

    ``fmt="delta"`` holds only when the session can load that format; otherwise
    tables fall back to Parquet.
    """
    spark = tune(SparkSession.builder.appName(app).getOrCreate())
    return spark, effective_format(spark, fmt)


def effective_format(spark: SparkSession, wanted: str) -> str:
    """The wanted table format when its classes are on the class path, else Parquet."""
    wanted = wanted.lower()
    if wanted != "delta":
        return wanted
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("io.delta.sql.DeltaSparkSessionExtension")
        return "delta"
    except Exception:  # the JVM raises ClassNotFoundException through py4j
        return "parquet"


def has_kafka(spark: SparkSession) -> bool:
    """Is the Kafka connector on the class path?"""
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False
