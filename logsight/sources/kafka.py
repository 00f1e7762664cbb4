"""Kafka options for event input and anomaly output (the connector is a cluster package)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.functions import values as V


def source_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None, allow_data_loss: bool = False
) -> dict:
    """Options of a topic as a source. Offsets that are gone end the stream unless their loss is allowed."""
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting offsets must be earliest or latest, not {starting!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(not allow_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = None,
    allow_data_loss: bool = False,
) -> DataFrame:
    """Messages as a stream with a text ``value`` column.

    Every query over this frame keeps its own checkpoint, which plays the part of a consumer group.
    """
    options = source_options(servers, topic, starting, max_offsets, allow_data_loss)
    return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))


def as_messages(df: DataFrame, key: str | None = "instance_id") -> DataFrame:
    """Rows as JSON text with timestamps in ISO UTC, keyed by a column when it exists."""
    times = {
        f.name: V.iso_utc(F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    text = df.withColumns(times) if times else df
    key_col = F.col(key).cast("string") if key and key in df.columns else F.lit(None).cast("string")
    return text.select(key_col.alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write of messages, for use inside ``foreachBatch``."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
