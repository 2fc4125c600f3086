"""Session builder. Every setting is a default a caller may override."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    # Day boundaries and NTZ -> TIMESTAMP casts depend on the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small-side broadcast by measured size, skewed-join splits,
    # and splitting of hot partitions behind the REBALANCE hint used by the sinks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partition folders hold text: a series named 007 or 2024-01-01 comes back as written.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Window state larger than the executor heap lives in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
