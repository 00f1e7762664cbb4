"""Jobs from the command line: ``spark-submit ... -m logsight <job>`` or ``python -m logsight <job>``."""

from __future__ import annotations

import argparse
from dataclasses import Field, fields, is_dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators.anomaly import AnomalyThresholds
from logsight.operators.windows import DEFAULT_WIDTH, minute_stats
from logsight.plans import backtest, models, report, retrain
from logsight.session import tune_for_scale
from logsight.sources import files, kafka, registry
from logsight.sources.store import (
    ANOMALIES_TABLE, MINUTE_STATS_TABLE, Lakehouse, bounded_run, enforce_retention, write_stats,
)
from logsight.streaming import events, landing, scoring, stats


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="logsight", description=__doc__)
    ap.add_argument("--root", required=True, help="folder of the lakehouses")
    ap.add_argument("--name", default="stream", help="lakehouse to use")
    jobs = ap.add_subparsers(dest="job", required=True)

    def streaming(name: str, about: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=about)
        p.add_argument("--messages", help="folder of JSON text files")
        p.add_argument("--servers", help="Kafka bootstrap servers")
        p.add_argument("--topic", default="events")
        p.add_argument("--starting", default="latest", choices=["earliest", "latest"])
        p.add_argument("--max-offsets", type=int)
        p.add_argument("--allow-data-loss", action="store_true", help="go on when the topic has lost offsets")
        p.add_argument("--trigger", default="1 minute", help="time between batches")
        p.add_argument("--checkpoint", help="needed by all streams")
        p.add_argument("--once", action="store_true", help="stop when there is nothing new")
        p.add_argument("--window", default=DEFAULT_WIDTH)
        return p

    windowed = streaming("stats", "windowed statistics")
    windowed.add_argument("--delay", default=stats.DELAY, help="how long windows wait for instances that lag")
    windowed.add_argument("--idle", default=stats.IDLE, help="lag after which an instance counts as silent")
    windowed.add_argument("--bounded", action="store_true", help="read the folder once and close every window")
    windowed.add_argument("--keep-days", type=int, help="days to keep in the table")
    windowed.add_argument("--archive", help="folder for older days")
    windowed.add_argument("--max-days", type=int, help="stop after so many event days")
    score = streaming("score", "anomalies of a stream")
    score.add_argument("--publish", help="topic for anomalies")
    score.add_argument("--max-days", type=int, help="stop after so many event days")
    streaming("collect", "published anomalies into the anomalies table")
    land = streaming("land", "training events by day")
    land.add_argument("--out", required=True)
    land.add_argument("--writer", help="name under which progress is kept, so that days can be known to be complete")
    land.add_argument("--max-days", type=int, help="stop after so many event days")
    land.add_argument("--codec", default="zstd", choices=landing.CODECS)
    streaming("rejects", "unreadable messages").add_argument("--out", required=True)

    train = jobs.add_parser("train", help="train on the latest landed days, on days that are due, or on files")
    source = train.add_mutually_exclusive_group(required=True)
    source.add_argument("--events", help="folder of landed events")
    source.add_argument("--files", help="comma-separated Parquet, ORC, JSON or Arrow files")
    source.add_argument("--manifest", help="text file of such paths")
    train.add_argument("--due", action="store_true", help="train every due day that all writers are done with")
    train.add_argument("--every", type=int, default=1, help="train each n-th landed day")
    train.add_argument("--incomplete", action="store_true", help="train days that writers may still add to")

    compact = jobs.add_parser("compact", help="few files for each landed day that all writers are done with")
    compact.add_argument("--events", required=True)

    for name, source in (("backtest", "--input"), ("follow", "--folder")):
        p = jobs.add_parser(name, help="train and score day by day")
        p.add_argument(source, required=True)
        p.add_argument("--start-day", type=date.fromisoformat)
        p.add_argument("--end-day", type=date.fromisoformat)
        p.add_argument("--pattern", default="*.parquet")
        for owner, f in settings():
            add_setting(p, owner, f)

    rep = jobs.add_parser("report", help="one of the reports")
    rep.add_argument("query", choices=sorted(REPORTS))
    rep.add_argument("--period", default="24h", choices=["24h", "1week"])
    rep.add_argument("--ids", default="", help="comma-separated instances; all when empty")
    rep.add_argument("--out", help="Parquet folder for the result; all rows are printed as JSON without it")
    return ap


REPORTS = {
    "instances": lambda s, a, tw, ids: report.instance_ids(s, tw),
    "critical_instances": lambda s, a, tw, ids: report.critical_instances(s, tw),
    "problem_types": lambda s, a, tw, ids: report.critical_problem_types(s, tw, ids),
    "metrics": lambda s, a, tw, ids: report.fleet_metrics(s, a, tw, ids),
    "anomalies": lambda s, a, tw, ids: report.anomaly_details(a, tw, ids),
    "chart": lambda s, a, tw, ids: report.class_chart(s, tw, ids),
    "shares": lambda s, a, tw, ids: report.class_shares(report.class_chart(s, tw, ids)),
    "totals": lambda s, a, tw, ids: report.totals_as_rows(report.class_totals(s, a, tw, ids)),
}


def messages(spark: SparkSession, args) -> DataFrame:
    if args.messages:
        return events.message_files(spark, args.messages)
    return kafka.read_topic(spark, args.servers, args.topic, args.starting, args.max_offsets, args.allow_data_loss)


def settings() -> list[tuple[str, Field]]:
    """The settings of a backtest and of its models and thresholds, by the name of what they belong to."""
    base = backtest.BacktestConfig()
    out = []
    for owner, config in (("model", base.model), ("thresholds", base.thresholds), ("", base)):
        out += [(owner, f) for f in fields(config) if not is_dataclass(getattr(config, f.name))]
    return out


def _flag(owner: str, name: str) -> str:
    """One flag per setting; what models and runs both have is told apart by its owner."""
    shared = name in {f.name for o, f in settings() if o != owner}
    return f"{owner}_{name}" if owner and shared else name


def add_setting(p: argparse.ArgumentParser, owner: str, f: Field) -> None:
    base = backtest.BacktestConfig()
    value = getattr(getattr(base, owner) if owner else base, f.name)
    kind = {"action": argparse.BooleanOptionalAction} if isinstance(value, bool) else {"type": type(value)}
    p.add_argument("--" + _flag(owner, f.name).replace("_", "-"), default=value, **kind)


def backtest_config(args) -> backtest.BacktestConfig:
    values: dict[str, dict] = {"model": {}, "thresholds": {}, "": {}}
    for owner, f in settings():
        values[owner][f.name] = getattr(args, _flag(owner, f.name))
    if values[""]["retrain_every_days"] < 1:
        raise SystemExit("a model must serve at least one day")
    return backtest.BacktestConfig(
        model=models.ModelConfig(**values["model"]), thresholds=AnomalyThresholds(**values["thresholds"]), **values[""]
    )


def train_latest(spark: SparkSession, lake: Lakehouse, path: str) -> str:
    """Train on the latest landed days and register the result; too few rows are an error."""
    config = models.ModelConfig()
    landed = spark.read.parquet(path)
    days = [r["day"] for r in files.latest_days(landed, config.train_window_days).orderBy("day").collect()]
    fitted = models.train_on(landed.where(landed["day"] >= days[0]), config) if days else None
    return _registered(lake, fitted, days[-1] if days else None, path, config)


def train_files(spark: SparkSession, lake: Lakehouse, paths: list[str]) -> str:
    """Train on whole files and register the result under their latest day."""
    config = models.ModelConfig()
    rows = files.scan_training_files(spark, paths, S.scoring_columns(config.target))
    newest = rows.agg(F.max(F.to_date(S.TIME))).first()[0]
    return _registered(lake, models.train_on(rows, config), newest, ", ".join(paths), config)


def _registered(lake: Lakehouse, fitted, day: date | None, source: str, config: models.ModelConfig) -> str:
    if fitted is None:
        raise ValueError(f"{source} has fewer than {config.min_train_rows} rows to train on")
    return registry.register(lake, fitted, day)


def train(spark: SparkSession, lake: Lakehouse, args) -> str:
    if args.files or args.manifest:
        named = files.parse_paths(args.files) if args.files else [r["path"] for r in files.read_manifest(spark, args.manifest).collect()]
        return train_files(spark, lake, named)
    if args.due:
        landed = spark.read.parquet(args.events)
        days = retrain.train_due(lake, landed, models.ModelConfig(), args.every, not args.incomplete)
        return ", ".join(d.isoformat() for d in days) or "no day is due"
    return train_latest(spark, lake, args.events)


def run(spark: SparkSession, args) -> DataFrame | None:
    lake = Lakehouse(spark, args.root, args.name)
    if args.job == "report":
        stored = stats.read_stats(lake)
        found = lake.read(ANOMALIES_TABLE, S.ANOMALIES)
        tw = report.time_window(stored, args.period)
        return REPORTS[args.query](stored, found, tw, report.parse_ids(args.ids) or None)
    if args.job == "train":
        print(train(spark, lake, args))
        return None
    if args.job == "compact":
        days = [r["day"] for r in landing.ready_days(landing.progress(lake)).orderBy("day").collect()]
        landing.compact_days(spark, args.events, days)
        return None
    if args.job == "backtest":
        print(backtest.run_backtest(spark, spark.read.parquet(args.input), lake, backtest_config(args), args.start_day, args.end_day))
        return None
    if args.job == "follow":
        print(backtest.run_follow(spark, args.folder, lake, backtest_config(args), args.pattern, args.start_day, args.end_day))
        return None

    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    if args.job == "stats" and args.bounded:
        if not args.messages:
            raise SystemExit("--bounded reads a folder: name it with --messages")
        text = spark.read.text(args.messages)
        write_stats(lake, minute_stats(events.events(text), args.window), bounded_run(args.messages))
        if args.keep_days:
            enforce_retention(lake, MINUTE_STATS_TABLE, args.keep_days, args.archive or lake.path("archive"))
        return None
    if not args.checkpoint:
        raise SystemExit(f"{args.job} needs --checkpoint")
    raw = messages(spark, args)
    if args.job == "stats":
        query = stats.start_stats(
            events.events(raw), lake, args.checkpoint, trigger, args.window, args.delay, args.idle,
            args.keep_days, args.archive, max_days=args.max_days,
        )
    elif args.job == "land":
        query = landing.start_landing(
            events.events(raw), args.out, args.checkpoint, trigger, args.codec, lake, args.writer, args.max_days
        )
    elif args.job == "collect":
        query = scoring.start_anomaly_windows(events.hit_events(raw), lake, args.checkpoint, trigger, args.window)
    elif args.job == "rejects":
        query = events.start_rejects(raw, args.out, args.checkpoint, trigger)
    else:
        publish = None
        if args.publish:
            def publish(rows: DataFrame) -> None:
                kafka.write_topic(kafka.as_messages(rows), args.servers, args.publish)
        query = scoring.start_scoring(
            events.events(raw), lake, args.checkpoint, trigger, width=args.window, publish=publish, max_days=args.max_days
        )
    query.awaitTermination()
    return None


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tune_for_scale(SparkSession.builder.appName(f"logsight-{args.job}")).getOrCreate()
    result = run(spark, args)
    if result is None:
        return
    if args.out:
        result.write.parquet(args.out)
    else:
        for row in result.toJSON().toLocalIterator():
            print(row)


if __name__ == "__main__":
    main()
