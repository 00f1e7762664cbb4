"""Trained models by version: an append-only table says which exist and which is the latest."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.plans.models import StageModels, load_models, save_models
from logsight.scratch import create_file, delete_folder
from logsight.sources.store import Lakehouse

REGISTRY = "models"
KEEP = 3

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("trained_on", T.DateType()),
        T.StructField("path", T.StringType()),
        T.StructField("config", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("retired", T.BooleanType()),
    ]
)


def versions(lake: Lakehouse) -> DataFrame:
    """Current state of every version: the last entry written about it."""
    entries = lake.read(REGISTRY, REGISTRY_SCHEMA)
    last = F.max_by(F.struct(*[c for c in REGISTRY_SCHEMA.names if c != "tag"]), "created_at").alias("e")
    return entries.groupBy("tag").agg(last).select("tag", "e.*").where(~F.col("retired"))


def latest(lake: Lakehouse, stage: str) -> DataFrame:
    """The newest version of a stage (no row when there is none)."""
    best = F.max_by(F.struct("tag", "path", "trained_on", "created_at"), F.struct("created_at", "trained_on", "tag")).alias("m")
    return versions(lake).where(F.col("stage") == stage).agg(best).where(F.col("m").isNotNull()).select("m.*")


def superseded(lake: Lakehouse, stage: str, keep: int = KEEP) -> DataFrame:
    age = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("created_at"), F.desc("tag")))
    return versions(lake).where(F.col("stage") == stage).withColumn("age", age).where(F.col("age") > keep).drop("age")


def register(lake: Lakehouse, models: StageModels, trained_on: date, keep: int = KEEP) -> str:
    """Save a version, make it the latest and retire all but the newest few with their files; returns its tag."""
    stage = models.config.stage
    tag = f"model_{stage}_{trained_on.isoformat()}"
    path = f"{lake.path('model_files')}/{tag}-{uuid.uuid4().hex[:8]}"
    save_models(models, path)
    entry = lake.spark.range(0, 1, 1, 1).select(
        F.lit(tag).alias("tag"),
        F.lit(stage).alias("stage"),
        F.lit(trained_on).alias("trained_on"),
        F.lit(path).alias("path"),
        F.lit(json.dumps(asdict(models.config))).alias("config"),
        F.current_timestamp().alias("created_at"),
        F.lit(False).alias("retired"),
    )
    _enter(lake, entry)
    gone = [r["path"] for r in superseded(lake, stage, keep).select("path").collect()]  # the few versions over keep
    old = superseded(lake, stage, keep).withColumns({"retired": F.lit(True), "created_at": F.current_timestamp()})
    if gone:
        _enter(lake, old.select(*REGISTRY_SCHEMA.names))
    for folder in gone:
        delete_folder(lake.spark, folder)
    return tag


def _enter(lake: Lakehouse, entries: DataFrame) -> None:
    """Add entries, in a folder of their own: of several runs that register at once none disturbs the others."""
    entries.write.parquet(f"{lake.path(REGISTRY)}/entry={uuid.uuid4().hex}")


def load_latest(lake: Lakehouse, stage: str) -> tuple[str, StageModels] | None:
    row = latest(lake, stage).first()
    return (row["tag"], load_models(lake.spark, row["path"])) if row else None


def trained(lake: Lakehouse, stage: str, day: date) -> bool:
    """Whether a version of the day was ever registered."""
    entries = lake.read(REGISTRY, REGISTRY_SCHEMA).where((F.col("stage") == stage) & (F.col("trained_on") == F.lit(day)))
    return not entries.isEmpty()


def claim(lake: Lakehouse, stage: str, day: date, owner: str, stale_hours: float = 24.0) -> bool:
    """Whether this owner may train the day: the first to ask is the only one.

    A claim is a file that can only be created once. One older than stale_hours is that of a run that died and
    gives way; a finished training leaves its claim, and its registry entry says that the day is done.
    """
    return create_file(lake.spark, _claim(lake, stage, day), owner, stale_hours)


def release(lake: Lakehouse, stage: str, day: date) -> None:
    """Give a claim back after a failed training, so that another run can try."""
    delete_folder(lake.spark, _claim(lake, stage, day))


def _claim(lake: Lakehouse, stage: str, day: date) -> str:
    return f"{lake.path('training_claims')}/{stage}-{day.isoformat()}"


def days_to_train(landed: DataFrame, lake: Lakehouse, stage: str, every: int = 1) -> DataFrame:
    """Landed days due for training: every n-th present day without a version yet."""
    if every <= 0:
        return landed.where(F.lit(False)).select("day")
    index = F.row_number().over(Window.orderBy("day")) - 1  # one row per day
    due = landed.select("day").distinct().withColumn("i", index).where(F.col("i") % every == 0)
    done = lake.read(REGISTRY, REGISTRY_SCHEMA).where(F.col("stage") == stage).select(F.col("trained_on").alias("day"))
    return due.join(done.distinct(), "day", "left_anti").select("day").orderBy("day")
