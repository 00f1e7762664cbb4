"""Message streams in, event streams out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.sources.ingest import accepted, decode_json, rejects


def message_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of JSON text files as a message stream; stands in for a topic."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(folder)


def events(messages: DataFrame) -> DataFrame:
    """Typed events; unreadable messages are left out and go to :func:`start_rejects`."""
    return accepted(decode_json(messages))


def start_rejects(messages: DataFrame, path: str, checkpoint: str, trigger: dict):
    """Keep unreadable messages with the reason, so that they neither stop the stream nor vanish."""
    return (
        rejects(decode_json(messages))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def hit_events(messages: DataFrame) -> DataFrame:
    """Anomaly hits that were published as JSON."""
    hit = F.from_json("value", S.ANOMALY_HIT)
    return messages.select(F.explode(F.array(hit)).alias("hit")).select("hit.*").where(F.col(S.TIME).isNotNull())
