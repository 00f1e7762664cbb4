"""Score batches of a stream with the latest model and keep the anomalies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators.anomaly import AnomalyThresholds, anomalies, hits
from logsight.operators.windows import DEFAULT_WIDTH, stamp_window
from logsight.plans.models import StageModels, score
from logsight.scratch import Scratch, materialise
from logsight.sources import registry
from logsight.sources.ingest import normalise_batch
from logsight.sources.store import ANOMALIES_TABLE, Lakehouse, run_id
from logsight.streaming.limits import start_batches


def detect(
    models: StageModels, raw: DataFrame, t: AnomalyThresholds = AnomalyThresholds(), keep: Scratch | None = None
) -> DataFrame:
    """Raw events to anomaly hits. Ranks are taken within the given rows."""
    scored = (keep or materialise)(score(models, normalise_batch(raw)), "scored")
    return hits(anomalies(scored, models.config.target, "pred_execution_ms", t))


def start_scoring(
    events: DataFrame,
    lake: Lakehouse,
    checkpoint: str,
    trigger: dict,
    stage: str = S.STAGE,
    width: str = DEFAULT_WIDTH,
    t: AnomalyThresholds = AnomalyThresholds(),
    publish: Callable[[DataFrame], None] | None = None,
    max_days: int | None = None,
):
    """Score every micro-batch; without a model yet, a batch is passed over.

    The registry is asked before each batch, so a new model takes effect with the next one.
    """
    loaded: dict[str, StageModels] = {}
    name = run_id(lake.spark, checkpoint)

    def current() -> StageModels | None:
        row = registry.latest(lake, stage).first()
        if row is None:
            return None
        if row["path"] not in loaded:
            loaded.clear()
            loaded[row["path"]] = registry.load_models(lake.spark, row["path"])
        return loaded[row["path"]]

    def run(batch: DataFrame, batch_id: int) -> None:
        models = current()
        if models is None or batch.isEmpty():
            return
        with Scratch(lake.spark) as keep:
            found = keep(stamp_window(detect(models, batch, t, keep), width), "hits")
            rows = found.select(*[F.col(f.name).cast(f.dataType) for f in S.ANOMALIES])
            lake.replace_batch(ANOMALIES_TABLE, rows, batch_id, "window_start", name)
            if publish is not None:
                publish(rows)

    return start_batches(events, run, checkpoint, trigger, max_days)


def start_anomaly_windows(
    hit_events: DataFrame,
    lake: Lakehouse,
    checkpoint: str,
    trigger: dict,
    width: str = DEFAULT_WIDTH,
):
    """Give each anomaly of a stream its window and keep it; no state is needed for that.

    For anomalies that come from a topic: a lakehouse is filled by this or by scoring, not both.
    """

    name = run_id(lake.spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = stamp_window(batch, width).select(*[F.col(f.name).cast(f.dataType) for f in S.ANOMALIES])
        lake.replace_batch(ANOMALIES_TABLE, rows, batch_id, "window_start", name)

    return hit_events.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(write).start()
