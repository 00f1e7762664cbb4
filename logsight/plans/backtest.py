"""Day by day: train on the days before, score the day, keep what stands out."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators.anomaly import (
    AnomalyThresholds,
    anomaly_summary,
    flag_rows,
    is_long,
)
from logsight.operators.ranks import instance_ranks
from logsight.operators.sampling import sample_per_group
from logsight.operators.windows import stamp_window
from logsight.plans.models import ModelConfig, StageModels, score, train_on
from logsight.scratch import Scratch
from logsight.sources import files, registry
from logsight.sources.store import ANOMALIES_TABLE, Lakehouse, ledger_rows, metadata_rows, pending_days


@dataclass(frozen=True)
class BacktestConfig:
    """Fixed values of a day-by-day run."""

    model: ModelConfig = field(
        default_factory=lambda: ModelConfig(drop_cached_train=True, train_window_days=7, max_train_rows=700_000)
    )
    thresholds: AnomalyThresholds = AnomalyThresholds()
    min_train_days: int = 2
    retrain_every_days: int = 1
    control_sample: int = 0
    seed: int = 0


LEDGER = "processed_days"


#: Ranks are taken within a day and instance.
RANKED_BY = ("day", S.INSTANCE)


def process_days(
    lake: Lakehouse, days: list[date], events: DataFrame, models: StageModels, config: BacktestConfig
) -> None:
    """Score the days of a frame with one model; write anomalies, controls, summaries and ledger.

    All days of a model go through the same few jobs. All rows count in the ranks of their day, but
    only long ones can be flagged and need theirs looked up. All tables are written per day and
    run, so running a day again replaces it.
    """
    with Scratch(lake.spark) as keep:
        _process(lake, days, events, models, config, keep)


def _process(lake, days: list[date], events: DataFrame, models: StageModels, c: BacktestConfig, keep: Scratch) -> None:
    stage, target, pred = models.config.stage, models.config.target, "pred_execution_ms"
    scored = keep(score(models, events).withColumn("stage", F.lit(stage)), "scored")
    ranks = instance_ranks(scored, target, pred, RANKED_BY)
    long = is_long(scored, target, c.thresholds)

    def flagged(rows: DataFrame) -> DataFrame:
        return flag_rows(rows, ranks, target, pred, c.thresholds, RANKED_BY)

    checked = keep(flagged(scored.where(long)), "checked")
    hits = checked.where("is_anomaly")
    run = f"backtest-{stage}"
    lake.replace_days(ANOMALIES_TABLE, _typed(stamp_window(hits)), days, run)
    for key, table in (("instance_id", "daily_instance_anomaly_summary"), ("user_id", "daily_user_anomaly_summary")):
        lake.replace_days(table, anomaly_summary(hits, key, ["day", "stage"]), days, run)
    if c.control_sample > 0:
        cleared = checked.where(~F.col("is_anomaly")).select(*scored.columns)
        pool = scored.where(~long).unionByName(cleared)
        sampled = flagged(sample_per_group(pool, c.control_sample, ["day"], seed=c.seed))
        lake.replace_days("controls", sampled, days, run)
    day_frame = lake.spark.createDataFrame([(d,) for d in days], "day date")
    lake.append(LEDGER, ledger_rows(day_frame, scored, hits, stage))


def _typed(hits: DataFrame) -> DataFrame:
    """Hits with the types of the anomalies table where it has their columns."""
    kinds = {f.name: f.dataType for f in S.ANOMALIES}
    return hits.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in hits.columns])


def _run(lake: Lakehouse, days: list[date], read_days, config: BacktestConfig, first: int, meta: dict) -> list[date]:
    """Walk the days in order. Each step is a Spark job; only the day list is on the driver."""
    stage, every = config.model.stage, config.retrain_every_days
    lake.append("run_metadata", metadata_rows(lake.spark, meta))
    day_frame = lake.spark.createDataFrame([(d,) for d in days], "day date")
    todo = {r["day"] for r in pending_days(day_frame, lake.read(LEDGER, S.PROCESSED_DAYS), stage).collect()}
    processed: list[date] = []
    i = first
    while i < len(days):
        window = days[max(0, i - config.model.train_window_days): i]
        models = None
        if days[i] in todo and len(window) >= config.min_train_days:
            models = train_on(read_days(window), config.model)
        if models is None:
            i += 1
            continue
        registry.register(lake, models, days[i])
        block = [d for d in days[i: i + every] if d in todo]
        process_days(lake, block, read_days(block), models, config)
        processed += block
        i += every
    return processed


def run_backtest(
    spark: SparkSession,
    log: DataFrame,
    lake: Lakehouse,
    config: BacktestConfig = BacktestConfig(),
    start: date | None = None,
    end: date | None = None,
) -> list[date]:
    """Backtest over a bounded log: every day is scored by a model of the days before it."""
    days = [r["day"] for r in files.between_days(files.distinct_days(log), start, end).collect()]
    if len(days) < 2:
        raise ValueError("a backtest needs at least two days")

    columns = [c for c in files_columns(config) if c in log.columns]

    def read_days(window: list[date]) -> DataFrame:
        # one time range reaches the scan; days in between that are not wanted are few
        ranged = files.between_times(log, window[0], window[-1]).select(*columns)
        dated = ranged.withColumn("day", F.to_date(S.TIME))
        return dated.where(F.col("day").isin(window))

    return _run(lake, days, read_days, config, 1, _meta("simulate", config, start=start, end=end))


def run_follow(
    spark: SparkSession,
    folder: str,
    lake: Lakehouse,
    config: BacktestConfig = BacktestConfig(),
    pattern: str = "*.parquet",
    start: date | None = None,
    end: date | None = None,
) -> list[date]:
    """The same over a folder of daily files; days in the ledger are skipped."""
    listed = files.daily_files(spark, folder, pattern).collect()  # one row per file
    by_day: dict[date, list[str]] = {}
    for r in listed:
        if (start is None or r["day"] >= start) and (end is None or r["day"] <= end):
            by_day.setdefault(r["day"], []).append(r["path"])
    if not by_day:
        raise ValueError("no daily file has a date in its name")
    columns = files_columns(config)

    def read_days(window: list[date]) -> DataFrame:
        paths = [p for d in window for p in by_day[d]]
        rows = spark.read.option("mergeSchema", "true").parquet(*paths)
        dated = rows.withColumn("day", files.day_of_path(F.col("_metadata.file_path")))
        return files.keep_present(dated, [*columns, "day"])

    meta = _meta("follow", config, folder=folder, pattern=pattern)
    return _run(lake, sorted(by_day), read_days, config, 0, meta)


def files_columns(config: BacktestConfig) -> list[str]:
    return S.backtest_columns(config.model.target)


def _meta(mode: str, config: BacktestConfig, **more) -> dict:
    return {"mode": mode, "created_at": datetime.now(timezone.utc).isoformat(), **asdict(config), **more}
