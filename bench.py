"""Headline queries, timed warm: prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    from pyspark.sql import DataFrame, SparkSession
    from pyspark.sql import functions as F

    from logsight.operators import anomaly, features, windows
    from logsight.operators.anomaly import anomalies, hits
    from logsight.plans import models, regimes, report
    from logsight.scratch import materialise, scratch_path
    from logsight.session import tune_for_scale
    from logsight.sources import ingest, kafka
    from logsight.sources.query_log import fixture_predictions, query_log
    from logsight.sources.store import Lakehouse
    from logsight.streaming import events as stream_events
    from logsight.streaming import stats as stream_stats

    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if "spark.checkpoint.dir" not in os.environ:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    spark = tune_for_scale(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    # the stored tables the queries run on, as ingestion would have left them
    log = materialise(query_log(spark, SF_DIR).repartition(int(CPUS)), "log")
    messages = materialise(kafka.as_messages(log).select("value"), "messages")
    counts = materialise(features.fingerprint_counts(log), "fingerprints")
    predicted = materialise(fixture_predictions(log), "predicted")
    stats = materialise(windows.minute_stats(log), "stats")
    flagged = materialise(windows.stamp_window(hits(anomalies(predicted))), "hits")
    message_dir = scratch_path(spark, "message-files")
    messages.write.text(message_dir)
    rows = log.count()
    week = report.time_window(stats, "1week")
    ids = [1, 2, 3, 5, 8]
    config = models.ModelConfig()
    trained: dict = {}

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def train() -> None:
        trained["models"] = models.train_on(log, config)

    def stream() -> None:
        lake = Lakehouse(spark, scratch_path(spark, "stream"), "stream")
        source = stream_events.events(stream_events.message_files(spark, message_dir))
        stream_stats.start_stats(source, lake, lake.path("checkpoint"), {"availableNow": True}).awaitTermination()

    cases = {
        "decode_messages": lambda: run(ingest.accepted(ingest.decode_json(messages))),
        "classify_and_window": lambda: run(windows.minute_stats(log)),
        "decode_classify_window": lambda: run(windows.minute_stats(ingest.accepted(ingest.decode_json(messages)))),
        "fill_cluster_size": lambda: run(windows.fill_cluster_size(log)),
        "prepare_features": lambda: run(features.prepare(log, counts)),
        "rank_and_flag_all": lambda: run(anomaly.flag(predicted)),
        "rank_and_flag_hits": lambda: run(anomalies(predicted)),
        "train_models": train,
        "score": lambda: run(models.score(trained["models"], log)),
        "fleet_metrics": lambda: run(report.fleet_metrics(stats, flagged, week, ids)),
        "critical_instances": lambda: run(report.critical_instances(stats, week)),
        "critical_problem_types": lambda: run(report.critical_problem_types(stats, week, ids)),
        "class_chart": lambda: run(report.class_chart(stats, week, ids)),
        "class_totals": lambda: run(report.class_totals(stats, flagged, week, ids)),
        "anomaly_details": lambda: run(report.anomaly_details(flagged, week, ids)),
        "class_distribution": lambda: run(regimes.class_distribution(log)),
        "scan_profile": lambda: run(regimes.scan_profile(log)),
        "sensitivity": lambda: run(regimes.sensitivity(log)),
        "streamed_minute_stats": stream,
    }
    timed_once = {"train_models"}
    seconds: dict[str, float] = {}
    for name, case in cases.items():
        case()  # warm
        times = []
        for _ in range(1 if name in timed_once else RUNS):
            start = time.perf_counter()
            case()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    per_row = [
        "decode_messages",
        "classify_and_window",
        "decode_classify_window",
        "fill_cluster_size",
        "prepare_features",
        "rank_and_flag_all",
        "rank_and_flag_hits",
        "train_models",
        "score",
        "streamed_minute_stats",
    ]
    print(
        json.dumps(
            {
                "metric": "total_seconds_warm_median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": {n: int(rows / seconds[n]) for n in per_row},
                "rows": rows,
                "trees": {"mean": trained["models"].mean.getNumTrees, "quantile": trained["models"].high.rounds},
                "cpus": int(CPUS),
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
