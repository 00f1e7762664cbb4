"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times without a zone are UTC, so the session must be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def tune_for_scale(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Adaptive execution with skew handling; sizes come from the cluster's own defaults."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
