"""Training when days are done: which days are due, who trains them, from which rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsight.plans.models import ModelConfig, train_on
from logsight.sources import registry
from logsight.sources.store import Lakehouse
from logsight.streaming import landing


def due_days(lake: Lakehouse, landed: DataFrame, stage: str, every: int = 1, complete: bool = True) -> DataFrame:
    """Landed days without a version, every n-th of all; with ``complete``, only those all writers are done with.

    A day is done for a writer once it has seen an event of a later one, so the newest day waits for the rollover.
    """
    due = registry.days_to_train(landed, lake, stage, every)
    return due.join(landing.ready_days(landing.progress(lake)), "day", "left_semi") if complete else due


def train_due(
    lake: Lakehouse,
    landed: DataFrame,
    config: ModelConfig,
    every: int = 1,
    complete: bool = True,
    train: Callable = train_on,
) -> list[date]:
    """Train each due day on its window of landed days up to it and register the model; the days trained.

    ``landed`` has the events with their ``day``. Several runs may be started at once: a day is trained by the
    one that claims it first. A training that fails gives its claim back; too few rows give no model, and the
    day stays due.
    """
    owner, trained = uuid.uuid4().hex, []
    days = [r["day"] for r in landed.select("day").distinct().orderBy("day").collect()]  # one row per day
    due = {r["day"] for r in due_days(lake, landed.select("day").distinct(), config.stage, every, complete).collect()}
    for i, day in enumerate(days):
        if day not in due or not registry.claim(lake, config.stage, day, owner):
            continue
        try:
            if registry.trained(lake, config.stage, day):  # by a run whose claim was already stale
                continue
            window = days[max(0, i + 1 - config.train_window_days) : i + 1]
            rows = landed.where((F.col("day") >= F.lit(window[0])) & (F.col("day") <= F.lit(day)))
            fitted = train(rows, config)
            if fitted is None:
                registry.release(lake, config.stage, day)
                continue
            registry.register(lake, fitted, day)
            trained.append(day)
        except BaseException:
            registry.release(lake, config.stage, day)
            raise
    return trained
