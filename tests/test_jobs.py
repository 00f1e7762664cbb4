"""Command-line jobs end to end, and shard import."""

import pyarrow as pa
import pyarrow.feather as feather
import pytest
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.__main__ import backtest_config, parser, run, train_latest
from logsight.sources import kafka
from logsight.sources.arrow_shards import scan_shards
from logsight.sources.store import Lakehouse


def job(spark, root, *words):
    return run(spark, parser().parse_args(["--root", str(root), *words]))


def test_stream_then_report(spark, log, tmp_path):
    week = log.where("arrival_timestamp < timestamp '2024-01-08'")
    kafka.as_messages(week).select("value").write.text(str(tmp_path / "in"))
    common = ["--messages", str(tmp_path / "in"), "--once"]
    job(spark, tmp_path, "stats", *common, "--checkpoint", str(tmp_path / "c1"), "--window", "1 hour")
    job(spark, tmp_path, "land", *common, "--checkpoint", str(tmp_path / "c2"), "--out", str(tmp_path / "landed"))
    totals = {r["type"]: r["count"] for r in job(spark, tmp_path, "report", "totals", "--period", "1week").collect()}
    assert totals["Total"] == sum(totals[k] for k in ("Normal", "CPU", "IO", "Network", "Queue/WLM"))
    assert totals["Anomalies"] == 0
    assert job(spark, tmp_path, "report", "instances").count() == 10
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert landed.count() == week.where("not was_cached and not was_aborted").count()
    assert train_latest(spark, Lakehouse(spark, str(tmp_path), "empty"), str(tmp_path / "landed")).endswith("2024-01-07")


def test_stream_with_retention(spark, log, tmp_path):
    kafka.as_messages(log.where("arrival_timestamp < timestamp '2024-01-08'")).select("value").write.text(str(tmp_path / "in"))
    words = ["--messages", str(tmp_path / "in"), "--once", "--checkpoint", str(tmp_path / "c"), "--window", "1 day"]
    job(spark, tmp_path, "stats", *words, "--keep-days", "4", "--archive", str(tmp_path / "old"))
    kept = Lakehouse(spark, str(tmp_path), "stream").read("minute_stats")
    # the last day's window is still open
    assert [r["d"] for r in kept.select(F.dayofmonth("window_start").alias("d")).distinct().orderBy("d").collect()] == [3, 4, 5, 6]
    old = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "old"))
    assert old.select(F.to_date("window_start")).distinct().count() == 2


def test_bounded_statistics_close_every_window(spark, log, tmp_path):
    day = log.where("arrival_timestamp < timestamp '2024-01-02'")
    kafka.as_messages(day).select("value").write.text(str(tmp_path / "in"))
    words = ["--messages", str(tmp_path / "in"), "--window", "1 hour", "--bounded"]
    job(spark, tmp_path, "stats", *words)
    job(spark, tmp_path, "stats", *words)  # replaces itself
    job(spark, tmp_path, "stats", *words[:-1], "--once", "--checkpoint", str(tmp_path / "c"))
    stats = Lakehouse(spark, str(tmp_path), "stream").read("minute_stats")
    assert stats.select("run").distinct().count() == 2
    kept = stats.where("run like 'bounded%'")
    assert kept.agg(F.sum("total_queries")).first()[0] == day.count()


def test_landed_days_are_trained_when_due(spark, log, tmp_path, capsys):
    kafka.as_messages(log.where("arrival_timestamp < timestamp '2024-01-05'")).select("value").write.text(str(tmp_path / "in"))
    words = ["--messages", str(tmp_path / "in"), "--once", "--checkpoint", str(tmp_path / "c"), "--out", str(tmp_path / "landed")]
    job(spark, tmp_path, "land", *words, "--writer", "w0", "--max-days", "3")
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert landed.select("day").distinct().count() == 3
    job(spark, tmp_path, "compact", "--events", str(tmp_path / "landed"))
    assert spark.read.parquet(str(tmp_path / "landed")).where("run = 'compacted'").select("day").distinct().count() == 2
    job(spark, tmp_path, "train", "--events", str(tmp_path / "landed"), "--due")
    assert capsys.readouterr().out.strip() == "2024-01-02"  # the first has too few rows, the last may get more
    job(spark, tmp_path, "train", "--events", str(tmp_path / "landed"), "--due")
    assert "no day is due" in capsys.readouterr().out


def test_training_from_named_files(spark, log, tmp_path, capsys):
    half = F.col("query_id") % 2
    log.where(half == 0).write.parquet(str(tmp_path / "a.parquet"))
    log.where(half == 1).write.orc(str(tmp_path / "b.orc"))
    (tmp_path / "list").write_text(f"{tmp_path / 'a.parquet'}\n\n{tmp_path / 'b.orc'}\n")
    job(spark, tmp_path, "train", "--manifest", str(tmp_path / "list"))
    assert "model_postcompile_2024-01-30" in capsys.readouterr().out
    with pytest.raises(ValueError, match="unsupported"):
        job(spark, tmp_path, "train", "--files", "x.csv")
    with pytest.raises(SystemExit):
        job(spark, tmp_path, "stats", "--messages", "x")


def test_lost_offsets_end_a_stream_unless_allowed():
    assert kafka.source_options("s", "t")["failOnDataLoss"] == "true"
    assert kafka.source_options("s", "t", allow_data_loss=True)["failOnDataLoss"] == "false"


def test_too_little_to_train_on_is_an_error(spark, log, tmp_path):
    log.limit(20).withColumn("day", F.to_date("arrival_timestamp")).write.parquet(str(tmp_path / "few"))
    with pytest.raises(ValueError, match="fewer than 500 rows"):
        train_latest(spark, Lakehouse(spark, str(tmp_path), "none"), str(tmp_path / "few"))


def test_every_setting_has_a_flag():
    words = ["--root", "r", "backtest", "--input", "i", "--quantile", "0.8", "--rare-below", "5", "--min-long-ms", "1", "--control-sample", "9"]
    config = backtest_config(parser().parse_args(words))
    assert (config.model.quantile, config.model.rare_below, config.thresholds.min_long_ms, config.control_sample) == (0.8, 5, 1.0, 9)
    with pytest.raises(SystemExit):
        backtest_config(parser().parse_args(["--root", "r", "backtest", "--input", "i", "--retrain-every-days", "0"]))


def test_shards(spark, tmp_path):
    for i in range(2):
        t = pa.table({"query_id": pa.array([i, i + 10], pa.int32()), "query_type": ["a", None], "extra": [1, 2]})
        feather.write_feather(t, str(tmp_path / f"{i}.arrow"), compression="lz4")
    wanted = S.T.StructType([S.QUERY_EVENT[c] for c in ("query_type", "query_id", "num_joins")])
    got = scan_shards(spark, [str(tmp_path / f"{i}.arrow") for i in range(2)], wanted)
    assert sorted(r["query_id"] for r in got.collect()) == [0, 1, 10, 11]
    assert got.where(F.col("num_joins").isNotNull()).count() == 0
