"""Land training events by day, and say when a writer is done with a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.scratch import delete_folder, folders_in, move_folder
from logsight.sources.ingest import landable
from logsight.sources.store import Lakehouse, run_id, waiting_writers
from logsight.streaming.limits import start_batches

CODECS = ("lz4", "zstd")


PROGRESS = "landing_progress"
STAGED = "_compacted"


def start_landing(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict,
    codec: str = "zstd",
    lake: Lakehouse | None = None,
    writer: str | None = None,
    max_days: int | None = None,
):
    """Land events worth training on as Parquet by day, each exactly once: a replayed batch replaces itself.

    Few files per day and batch are written, and a busy day is split. With a writer's name, how far it has got
    is recorded after each batch has landed. With ``max_days`` the stream ends when those days are over.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, not {codec!r}")
    run = run_id(events.sparkSession, checkpoint)
    spark = events.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        keys = {"day": F.to_date(S.TIME), "run": F.lit(run), "batch_id": F.lit(int(batch_id)).cast("long")}
        (
            landable(batch).withColumns(keys)
            .hint("rebalance", "day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", codec)
            .partitionBy("day", "run", "batch_id")
            .parquet(path)
        )
        if writer is not None:
            record_progress(batch, batch_id, lake, writer, run)

    return start_batches(events, write, checkpoint, trigger, max_days)


def record_progress(batch: DataFrame, batch_id: int, lake: Lakehouse, writer: str, run: str) -> None:
    seen = batch.groupBy(F.to_date(S.TIME).alias("seen_day")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(S.TIME).alias("latest")
    )
    lake.replace_batch(PROGRESS, seen.withColumn("writer", F.lit(writer)), batch_id, "seen_day", run)


def start_progress(events: DataFrame, lake: Lakehouse, writer: str, checkpoint: str, trigger: dict):
    """Keep, per batch and day, how far a writer has got in event time; all writers share the table."""
    run = run_id(lake.spark, checkpoint)
    return start_batches(
        events.select(S.TIME), lambda batch, i: record_progress(batch, i, lake, writer, run), checkpoint, trigger
    )


def compact_days(spark: SparkSession, path: str, days: list[date], file_rows: int = 5_000_000) -> None:
    """Rewrite closed days, whose batches left many files, as few files each.

    A day is written aside first, then takes the place of its batches; a run that ended in between is finished
    by the next, so no row is lost or doubled for good. Days must have no more batches to come.
    """
    for day in days:
        folder, staged = f"{path}/day={day.isoformat()}", f"{path}/{STAGED}/day={day.isoformat()}"
        if "_SUCCESS" not in folders_in(spark, staged):
            runs = [n for n in folders_in(spark, folder) if n.startswith("run=")]
            if not runs or runs == ["run=compacted"]:
                continue
            rows = spark.read.option("mergeSchema", "true").parquet(folder).drop("run", "batch_id")
            rows.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(staged)
        delete_folder(spark, folder)
        move_folder(spark, staged, f"{folder}/run=compacted/batch_id=0")


PROGRESS_SCHEMA = "seen_day date, writer string, rows long, latest timestamp, day date, run string, batch_id long"


def active_writers(progress: DataFrame) -> DataFrame:
    return progress.select(F.col("seen_day").alias("day"), "writer").distinct()


def complete_days(progress: DataFrame) -> DataFrame:
    """A writer is done with a day once it has seen an event of a later one."""
    reached = progress.groupBy("writer").agg(F.max("seen_day").alias("reached"))
    return (
        active_writers(progress)
        .join(reached, "writer")
        .where(F.col("day") < F.col("reached"))
        .select("day", "writer")
    )


def incomplete(progress: DataFrame) -> DataFrame:
    return waiting_writers(active_writers(progress), complete_days(progress))


def progress(lake: Lakehouse) -> DataFrame:
    """How far all writers have got; no rows before the first batch."""
    return lake.read(PROGRESS, PROGRESS_SCHEMA).select("seen_day", "writer", "rows", "latest")


def ready_days(progress: DataFrame) -> DataFrame:
    """Days that every writer with rows of them is done with."""
    waiting = incomplete(progress).select("day").distinct()
    return active_writers(progress).select("day").distinct().join(waiting, "day", "left_anti")
