"""Result tables: evolution, replay, ledger, retention, registry, backtest."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators import windows
from logsight.plans import backtest, boosting, models, report, retrain
from logsight.sources import registry, store
from logsight.streaming import landing
from logsight.streaming.scoring import detect
from logsight.streaming.stats import read_stats


def test_append_evolves(spark, lake):
    lake.append("t", spark.createDataFrame([(1, "a")], "x long, y string"))
    lake.append("t", spark.createDataFrame([("b", 2, 0.5)], "y string, x int, z double"))
    lake.append("t", spark.createDataFrame([(3,)], "x long"))
    lake.append("t", spark.createDataFrame([], "x long, w string"))
    got = sorted(tuple(r) for r in lake.read("t").select("x", "y", "z").collect())
    assert got == [(1, "a", None), (2, "b", 0.5), (3, None, None)]
    assert "w" not in lake.read("t").columns


def test_replay_replaces_batch(spark, lake):
    rows = spark.createDataFrame([(datetime(2024, 1, 1), 1), (datetime(2024, 1, 2), 2)], "ts timestamp, x int")
    for batch in (0, 1, 1):
        lake.replace_batch("t", rows, batch, "ts", "one")
    assert lake.read("t").count() == 4
    lake.replace_batch("t", rows, 0, "ts", "two")  # batches of another checkpoint are others
    assert lake.read("t").count() == 6


def test_runs_are_named_by_their_checkpoint(spark, tmp_path):
    a, b = (store.run_id(spark, str(tmp_path / x)) for x in "ab")
    assert a != b and store.run_id(spark, str(tmp_path / "a")) == a


def test_append_widens_and_stores_no_null_for_a_value(spark, lake):
    """int, then long, double and text; what was written before is not rewritten."""
    lake.append("n", spark.createDataFrame([(1, 5)], "x int, y long"))
    first = spark.read.parquet(lake.path("n")).inputFiles()
    lake.append("n", spark.createDataFrame([(1 << 40,), (None,)], "x long"))
    assert lake.read("n").schema["x"].dataType.simpleString() == "bigint"
    lake.append("n", spark.createDataFrame([(2,)], "x int"))  # narrower: becomes the known type
    assert len(lake.versions("n")) == 2
    lake.append("n", spark.createDataFrame([(0.5, 7)], "x double, y int"))
    lake.append("n", spark.createDataFrame([("abc",)], "x string"))
    got = lake.read("n")
    assert sorted(str(r["x"]) for r in got.collect()) == sorted(["1", str(1 << 40), "None", "2", "0.5", "abc"])
    assert sorted(r["y"] for r in got.where("y is not null").collect()) == [5, 7]
    assert spark.read.parquet(lake.path("n")).inputFiles() == first
    lake.append("days", spark.createDataFrame([(date(2024, 1, 1),)], "x date"))
    with pytest.raises(Exception, match="does not fit date|DATATYPE_MISMATCH"):
        lake.append("days", spark.createDataFrame([(5,)], "x int"))


def test_streams_and_bounded_runs_share_a_table(spark, lake, log, tmp_path):
    """One layout: a stream, a bounded run and a backtest write the same tables, twice each, and all can be read."""
    day = log.where("arrival_timestamp < timestamp '2024-01-02'")
    expected = windows.minute_stats(day, "1 hour")
    for _ in range(2):
        lake.replace_batch(store.MINUTE_STATS_TABLE, expected, 0, "window_start", "stream")
        store.write_stats(lake, expected, store.bounded_run("folder"))
    assert read_stats(lake).count() == 2 * expected.count()
    assert lake.read(store.MINUTE_STATS_TABLE).select("run").distinct().count() == 2
    hits = log.limit(4).select(*[F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.ANOMALIES])
    hits = hits.withColumn("window_start", F.date_trunc("hour", S.TIME))
    days = [r["d"] for r in hits.select(F.to_date(S.TIME).alias("d")).distinct().collect()]
    for _ in range(2):
        store.write_anomalies(lake, hits, "bounded")
        lake.replace_batch(store.ANOMALIES_TABLE, hits, 3, "window_start", "stream")
        lake.replace_days(store.ANOMALIES_TABLE, hits.withColumns({"day": F.to_date(S.TIME), "stage": F.lit("s")}), days, "backtest-s")
    assert lake.read(store.ANOMALIES_TABLE).count() == lake.read(store.ANOMALIES_TABLE, S.ANOMALIES).count() == 12


def test_archive_replaces_itself(spark, lake, tmp_path):
    """A day that is archived again, after a run that ended before its rows were dropped, is there once."""
    days = [(datetime(2024, 1, d), d) for d in range(1, 5)]
    rows = spark.createDataFrame(days, "window_start timestamp, n int")
    for _ in range(2):
        lake.replace_batch("t", rows, 0, "window_start", "one")
        assert store.enforce_retention(lake, "t", 2, str(tmp_path / "old")) == 2
    assert spark.read.parquet(str(tmp_path / "old" / "t")).count() == 2


def test_claims_have_one_winner(spark, lake):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: registry.claim(lake, "s", date(2024, 1, 1), f"o{i}"), range(16)))
    assert sum(won) == 1
    assert not registry.claim(lake, "s", date(2024, 1, 1), "later")
    registry.release(lake, "s", date(2024, 1, 1))
    assert registry.claim(lake, "s", date(2024, 1, 1), "again")
    assert registry.claim(lake, "s", date(2024, 1, 1), "much later", stale_hours=0.0)


def test_due_days_are_trained_once(spark, lake, log, fitted):
    landed = log.where("arrival_timestamp < timestamp '2024-01-06'").withColumn("day", F.to_date(S.TIME)).cache()
    seen = landed.groupBy(F.col("day").alias("seen_day")).agg(F.count("*").alias("rows"), F.max(S.TIME).alias("latest"))
    for writer, upto in (("a", 5), ("b", 3)):
        rows = seen.where(F.dayofmonth("seen_day") <= upto).withColumn("writer", F.lit(writer))
        lake.replace_batch(landing.PROGRESS, rows, 0, "seen_day", writer)
    done = [r["day"].day for r in landing.ready_days(landing.progress(lake)).orderBy("day").collect()]
    assert done == [1, 2, 4]  # day 3 waits for b, day 5 for a; b has nothing of day 4
    windows_of = []

    def train(rows, config):
        windows_of.append(sorted(r["day"].day for r in rows.select("day").distinct().collect()))
        return fitted

    config = models.ModelConfig(train_window_days=2)
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(retrain.train_due, lake, landed, config, train=train) for _ in range(2)]
        trained = sum((r.result() for r in runs), [])
    assert sorted(d.day for d in trained) == [1, 2, 4] and sorted(windows_of) == [[1], [1, 2], [3, 4]]
    assert retrain.train_due(lake, landed, config, train=train) == []

    def fails(rows, config):
        raise RuntimeError("no memory")

    with pytest.raises(RuntimeError):
        retrain.train_due(lake, landed, config, complete=False, train=fails)
    assert [d.day for d in retrain.train_due(lake, landed, config, complete=False, train=train)] == [3, 5]


@pytest.mark.parametrize("present,kept", [(7, 7), (8, 8), (9, 8)])
def test_retention(spark, lake, present, kept):
    days = [(datetime(2024, 1, 1) + timedelta(days=2 * i), i) for i in range(present)]
    df = spark.createDataFrame(days, "window_start timestamp, n int").withColumn("day", F.to_date("window_start"))
    lake.append("t", df, ["day"])
    moved = store.enforce_retention(lake, "t", 8, lake.path("archive"))
    assert (lake.read("t").count(), moved) == (kept, present - kept)
    if moved:
        archived = spark.read.option("recursiveFileLookup", "true").parquet(lake.path("archive"))
        assert archived.count() == moved


def test_metadata_and_missing_table(spark, lake):
    lake.append("run_metadata", store.metadata_rows(spark, {"a": [1, 2], "b": date(2024, 1, 1)}))
    assert {r["k"]: r["v"] for r in lake.read("run_metadata").collect()} == {"a": "[1, 2]", "b": '"2024-01-01"'}
    assert lake.read("none", S.PROCESSED_DAYS).count() == 0


def test_report_periods(spark):
    stats = spark.createDataFrame([(datetime(2024, 3, 15, 12),)], "window_start timestamp")
    day, week = report.time_window(stats, "24h"), report.time_window(stats, "1week")
    assert day.start.replace(tzinfo=None) == datetime(2024, 3, 14, 12)
    assert day.previous_start.replace(tzinfo=None) == datetime(2024, 3, 13, 12)
    assert week.start.replace(tzinfo=None) == datetime(2024, 3, 8, 12)
    assert week.previous_start.replace(tzinfo=None) == datetime(2024, 3, 1, 12)
    with pytest.raises(NotImplementedError):
        report.time_window(stats, "fortnight")
    assert report.time_window(stats.limit(0), "24h").start.year >= 2024


def stats_rows(spark, rows):
    """(instance, hour, total, cpu) rows as a statistics table."""
    full = [(datetime(2024, 1, 2, h), i, -1, n, n - cpu, cpu, 0, 0, 0, 0.0, 0.0, 0.0) for i, h, n, cpu in rows]
    return spark.createDataFrame(full, S.MINUTE_STATS)


def test_critical_boundaries(spark):
    stats = stats_rows(spark, [(1, 0, 1000, 50), (2, 0, 1020, 51), (3, 0, 100, 5), (4, 0, 100, 6), (5, 0, 0, 0), (6, 12, 1, 0)])
    tw = report.time_window(stats, "24h")
    assert [r[0] for r in report.critical_instances(stats, tw).collect()] == [2, 4]
    assert [r[0] for r in report.critical_problem_types(stats, tw, [1, 3]).collect()] == []
    assert [r[0] for r in report.critical_problem_types(stats, tw, [1, 2]).collect()] == ["cpu_bound"]
    assert report.critical_problem_types(stats, tw, []).count() == 0


def test_anomalies_without_queries(spark):
    stats = stats_rows(spark, [(1, 0, 10, 1)])
    tw = report.time_window(stats, "24h")
    hit = spark.createDataFrame([(datetime(2024, 1, 2), 9)], "arrival_timestamp timestamp, instance_id long")
    both = report.class_totals(stats, hit, tw, [9]).first()
    assert both["anomalies_count"] == 1 and both["anomalies_pct"] is None
    assert report.class_totals(stats, hit, tw, [8]).first()["anomalies_pct"] == 0.0
    metrics = report.fleet_metrics(stats, hit, tw, [8]).first()
    assert metrics["score"] == 0.0 and metrics["anomalies_count_delta"] == 0.0


def test_instance_ids_from_a_frame(spark):
    stats = stats_rows(spark, [(1, 0, 10, 1), (2, 0, 10, 9)])
    ids = report.critical_instances(stats, report.time_window(stats, "24h"), count=8, share=0.5)
    assert [r["instance_id"] for r in report.for_instances(stats, ids).collect()] == [2]


QUICK = models.ModelConfig(max_iter=3, train_classifiers=True, min_leaf_rows=20, classifier_iter=2, classifier_depth=4)


@pytest.fixture(scope="module")
def fitted(log):
    return models.train_on(log, QUICK)


def test_predictions(log, fitted):
    out = models.score(fitted, log)
    stats = out.agg(
        F.min("pred_execution_ms").alias("low"),
        F.avg((F.col(S.TARGET) <= F.col("pred_q_ms")).cast("int")).alias("covered"),
        F.count_if(F.col("pred_execution_ms") < F.greatest("pred_mean_ms", "pred_q_ms")).alias("below"),
        F.min("p_explode").alias("p_low"),
        F.max("p_explode").alias("p_high"),
        F.count_distinct("pred_quartile").alias("quartiles"),
        F.count("*").alias("n"),
    ).first()
    assert stats["low"] >= 1.0 and stats["below"] == 0
    assert 0.87 < stats["covered"] < 0.93
    assert 0.0 <= stats["p_low"] <= stats["p_high"] <= 1.0 and 2 <= stats["quartiles"] <= 4
    assert stats["n"] == log.where(~F.col("was_aborted")).count()


def test_unseen_category_is_scored(log, fitted):
    odd = log.limit(5).withColumns({"query_type": F.lit("never seen"), "feature_fingerprint": F.lit("new")})
    out = models.score(fitted, odd)
    assert out.where("pred_execution_ms >= 1").count() == out.count()


def test_fingerprints_are_counted_over_all_rows(spark, log):
    few = models.ModelConfig(max_train_rows=2000, max_iter=2)
    counted = models.train_on(log, few).fingerprints.agg(F.sum("fp_freq")).first()[0]
    assert counted == log.count()


def test_boosting_gains_over_many_rounds(spark):
    """A target that adds up over several features needs many small trees."""
    import math

    from pyspark.ml.feature import VectorAssembler

    x = [f"x{i}" for i in range(6)]
    rows = spark.range(6000).select("id", *[(F.rand(i) * 4).alias(c) for i, c in enumerate(x)])
    label = sum((F.sin(F.col(c) * (i + 1)) * 2 for i, c in enumerate(x)), F.lit(0.0))
    frame = rows.withColumn("label", label + F.randn(9) * 0.1).withColumn("held_out", F.col("id") % 5 == 0)
    frame = VectorAssembler(inputCols=x, outputCol="features").transform(frame).cache()
    fitted, losses = boosting.boost_mean(frame, boosting.Boosting(depth=3, rounds=60, step=0.1, cut_every=30))
    assert fitted.getNumTrees == len(losses) > 50 and losses[-1] < 0.6 * losses[0] and not math.isnan(losses[-1])
    # the model is what its losses say: continued fits add up, and the prefix is theirs
    scored = fitted.setPredictionCol("p").transform(frame.where("held_out"))
    assert scored.agg(F.avg(F.pow(F.col("p") - F.col("label"), 2))).first()[0] == pytest.approx(losses[-1], rel=1e-6)


def test_too_few_rows(log):
    assert models.train_on(log.limit(100), QUICK) is None


def test_registry(spark, lake, log, fitted):
    assert registry.load_latest(lake, S.STAGE) is None
    for d in (1, 3, 5):
        registry.register(lake, fitted, date(2024, 1, d), keep=2)
    assert registry.versions(lake).count() == 2
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(lake.path("model_files"))
    assert files.select(F.regexp_extract("path", "2024-01-0[135]", 0)).distinct().count() == 2
    tag, loaded = registry.load_latest(lake, S.STAGE)
    assert tag == "model_postcompile_2024-01-05"
    a = models.score(fitted, log).agg(F.sum("pred_execution_ms")).first()[0]
    b = models.score(loaded, log).agg(F.sum("pred_execution_ms")).first()[0]
    assert a == pytest.approx(b)
    assert detect(loaded, log).schema.names == S.ANOMALY_HIT.names
    landed = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 9)], "day date")
    assert [r["day"].day for r in registry.days_to_train(landed, lake, S.STAGE, 2).collect()] == [7]
    assert registry.days_to_train(landed, lake, S.STAGE, 0).count() == 0


def test_backtest_is_incremental(spark, lake, log):
    config = backtest.BacktestConfig(
        model=models.ModelConfig(max_iter=1, train_window_days=3, drop_cached_train=True),
        retrain_every_days=2,
        control_sample=7,
    )
    scratch = spark.conf.get("spark.checkpoint.dir") + "/logsight"
    before = set(os.listdir(scratch))
    first = backtest.run_backtest(spark, log, lake, config, end=date(2024, 1, 4))
    assert first == [date(2024, 1, 3), date(2024, 1, 4)]
    anomalies = lake.read("anomalies").count()
    assert backtest.run_backtest(spark, log, lake, config, end=date(2024, 1, 4)) == []
    assert lake.read("anomalies").count() == anomalies
    ledger = lake.read(backtest.LEDGER).collect()
    assert sum(r["rows_anoms"] for r in ledger) == anomalies
    assert lake.read("controls").count() == 14 and lake.read("controls").where("is_anomaly").count() == 0
    left = set(os.listdir(scratch)) - before
    assert not [f for f in left if f.startswith(("scored", "checked", "sample", "prepared"))]
    assert lake.read("daily_instance_anomaly_summary").agg(F.sum("anoms")).first()[0] == anomalies


def test_follow_reads_daily_files(spark, lake, log, tmp_path):
    for d in range(1, 5):
        day = date(2024, 1, d)
        log.where(F.to_date("arrival_timestamp") == F.lit(day)).write.parquet(str(tmp_path / f"q_{day}.parquet"))
    config = backtest.BacktestConfig(model=models.ModelConfig(max_iter=1), retrain_every_days=9)
    assert backtest.run_follow(spark, str(tmp_path), lake, config) == [date(2024, 1, 3), date(2024, 1, 4)]
    with pytest.raises(ValueError):
        backtest.run_follow(spark, str(tmp_path), lake, config, pattern="none*")
