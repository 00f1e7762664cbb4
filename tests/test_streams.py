"""Streams: rejects, lateness, state across batches, replay, scoring."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators.windows import minute_stats
from logsight.operators.anomaly import AnomalyThresholds
from logsight.plans import models
from logsight.sources import kafka, registry
from logsight.sources.store import ANOMALIES_TABLE
from logsight.streaming import events, landing, scoring, stats

NOW = {"availableNow": True}


def message(query_id, at, **more):
    base = {"instance_id": 1, "query_id": query_id, "arrival_timestamp": at, "query_type": "select", "execution_duration_ms": 10}
    return json.dumps({**base, **more})


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def run_stats(spark, lake, folder, checkpoint):
    stream = events.events(events.message_files(spark, str(folder)))
    stats.start_stats(stream, lake, checkpoint, NOW, delay="0 seconds", idle="0 seconds").awaitTermination()


def table(lake):
    rows = stats.read_stats(lake).orderBy("window_start", "instance_id").collect()
    return [(r["window_start"].strftime("%H:%M"), r["instance_id"], r["total_queries"], r["cluster_size"]) for r in rows]


def test_windows_close_and_sizes_are_remembered(spark, lake, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    put(folder, "a.json", [
        message(1, "2024-01-01T00:01:00Z", cluster_size=4),
        message(3, "2024-01-01T00:09:00Z"),
        message(2, "2024-01-01T00:02:00Z", cluster_size="8"),  # out of order within a batch
        message(4, "2024-01-01T00:12:00Z", instance_id=2),
        "not json",
        message(5, "soon"),
        json.dumps({"instance_id": 1, "query_id": 6}),
    ])
    run_stats(spark, lake, folder, checkpoint)
    assert table(lake) == [("00:00", 1, 3, 8)]
    put(folder, "b.json", [message(7, "2024-01-01T00:15:00Z"), message(8, "2024-01-01T00:25:00Z")])
    run_stats(spark, lake, folder, checkpoint)
    assert table(lake) == [("00:00", 1, 3, 8), ("00:10", 1, 1, 8), ("00:10", 2, 1, -1)]
    # far behind the watermark: the closed window does not change
    put(folder, "c.json", [message(9, "2024-01-01T00:03:00Z"), message(10, "2024-01-01T00:40:00Z")])
    run_stats(spark, lake, folder, checkpoint)
    assert table(lake)[:1] == [("00:00", 1, 3, 8)] and table(lake)[-1] == ("00:20", 1, 1, 8)
    assert [(r["query_id"], r["window_start"].minute) for r in lake.read(stats.LATE_TABLE).collect()] == [(9, 0)]
    counts = lake.read(stats.COUNTS_TABLE)
    assert [tuple(r) for r in counts.orderBy("batch_id").select("rows_in", "rows_late", "windows_closed", "windows_open").collect()] == [
        (4, 0, 1, 1), (2, 0, 2, 1), (2, 1, 1, 1)
    ]
    run_stats(spark, lake, folder, checkpoint)  # nothing new
    assert len(table(lake)) == 4


def test_instances_have_their_own_clocks(spark, lake, tmp_path):
    """An instance that lags loses nothing; what comes after its own clock has passed is late."""
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def batch(name, lines):
        put(folder, name, lines)
        stream = events.events(events.message_files(spark, str(folder)))
        stats.start_stats(stream, lake, checkpoint, NOW).awaitTermination()

    batch("a.json", [message(1, "2024-01-01T00:01:00Z"), message(2, "2024-01-01T09:00:00Z", instance_id=2)])
    batch("b.json", [message(3, "2024-01-01T00:02:00Z"), message(4, "2024-01-01T01:05:00Z")])  # 9 hours behind the other
    assert table(lake) == []
    batch("c.json", [message(5, "2024-01-01T01:30:00Z", cluster_size=6), message(6, "2024-01-01T00:03:00Z")])
    assert table(lake) == [("00:00", 1, 3, -1)]  # in one batch with what closes it: counted
    batch("d.json", [message(7, "2024-01-01T00:04:00Z"), message(8, "2024-01-01T09:05:00Z", instance_id=2)])
    assert [r["query_id"] for r in lake.read(stats.LATE_TABLE).collect()] == [7]
    # one that is silent for a day is closed by the others
    batch("e.json", [message(9, "2024-01-02T02:00:00Z", instance_id=2), message(10, "2024-01-02T04:00:00Z", instance_id=3)])
    assert table(lake) == [("00:00", 1, 3, -1), ("01:00", 1, 1, -1), ("01:30", 1, 1, 6), ("09:00", 2, 2, -1)]
    left = stats.open_windows(spark, checkpoint)
    assert sorted((r["instance_id"], r["total_queries"]) for r in left.collect()) == [(2, 1), (3, 1)]


def test_replayed_batch_replaces_itself(spark, lake, log, tmp_path):
    """The state of a batch is read from the one before, so running it again changes nothing."""
    state = stats.WindowState(spark, str(tmp_path / "state"))
    day = log.where("arrival_timestamp < timestamp '2024-01-03'")
    for batch_id, half in ((4, 0), (7, 1), (7, 1)):  # a number in between had no rows
        open_, instances = state.before(batch_id)
        fresh = stats.window_partials(day.where(F.col("query_id") % 2 == half))
        windows, clocks = stats.advance(fresh, open_, instances, delay="1000 days")
        state.write(batch_id, windows, clocks)
        state.forget()
    got = state.before(99)[0].select("window_start", "instance_id", "total_queries")
    assert got.exceptAll(minute_stats(day).select("window_start", "instance_id", "total_queries")).count() == 0
    assert got.agg(F.sum("total_queries")).first()[0] == day.count()


def test_rejects_are_kept(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", ["{broken", message(1, None), message(2, "2024-01-01T00:00:00Z"), ""])
    out = str(tmp_path / "rejects")
    events.start_rejects(events.message_files(spark, str(folder)), out, str(tmp_path / "cp"), NOW).awaitTermination()
    got = {r["reject_reason"]: r["n"] for r in spark.read.parquet(out).groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert got["bad_timestamp"] >= 1 and got["malformed_json"] >= 1 and sum(got.values()) == 3


def test_stream_equals_batch(spark, lake, log, tmp_path):
    closing = log.limit(1).withColumn("arrival_timestamp", F.lit("2024-03-01").cast("timestamp"))
    messages = kafka.as_messages(log.unionByName(closing)).select("value")
    messages.coalesce(1).write.text(str(tmp_path / "in"))
    run_stats(spark, lake, tmp_path / "in", str(tmp_path / "cp"))
    streamed = stats.read_stats(lake).drop("day")
    batch = minute_stats(log)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_landing_and_progress(spark, lake, log, tmp_path):
    log.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    landing.start_landing(source, str(tmp_path / "out"), str(tmp_path / "cp1"), NOW, "lz4").awaitTermination()
    landing.start_progress(source, lake, "w0", str(tmp_path / "cp2"), NOW).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "out"))
    assert landed.count() == log.where("not was_cached and not was_aborted").count()
    assert landed.select("day").distinct().count() == 30
    progress = landing.progress(lake)
    assert progress.agg(F.sum("rows")).first()[0] == log.count()
    assert [r["day"] for r in landing.incomplete(progress).collect()] == [date(2024, 1, 30)]
    with pytest.raises(ValueError):
        landing.start_landing(source, "x", "y", NOW, "gzip")


def test_landing_with_progress_and_compaction(spark, lake, log, tmp_path):
    path, folder = str(tmp_path / "out"), tmp_path / "in"
    for d in (1, 2, 3):
        log.where(F.dayofmonth("arrival_timestamp").between(d, d + 1) & (F.col("query_id") % 3 == d - 1)).write.mode("append").parquet(str(folder))
        source = spark.readStream.schema(log.schema).parquet(str(folder))
        landing.start_landing(source, path, str(tmp_path / "cp"), NOW, lake=lake, writer="w").awaitTermination()
    before = spark.read.parquet(path)
    rows, days = before.drop("run", "batch_id"), landing.ready_days(landing.progress(lake))
    done = [r["day"] for r in days.orderBy("day").collect()]
    assert [d.day for d in done] == [1, 2, 3]
    expected = {r["query_id"] for r in rows.collect()}
    landing.compact_days(spark, path, done)
    landing.compact_days(spark, path, done)
    after = spark.read.parquet(path)
    assert after.count() == len(expected) and {r["query_id"] for r in after.select("query_id").collect()} == expected
    assert after.where("run = 'compacted'").select("day").distinct().count() == 3
    # a run that ended with the day written aside and dropped, but not moved
    import shutil

    staged = f"{path}/_compacted/day=2024-01-02"
    shutil.move(f"{path}/day=2024-01-02/run=compacted/batch_id=0", staged)
    landing.compact_days(spark, path, done)
    assert spark.read.parquet(path).count() == len(expected)


def test_stream_ends_after_its_days(spark, lake, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", [message(i, f"2024-01-0{1 + i % 4}T0{i % 5}:00:00Z") for i in range(20)])
    stream = events.events(events.message_files(spark, str(folder)))
    query = stats.start_stats(stream, lake, str(tmp_path / "cp"), {"processingTime": "0 seconds"}, max_days=2)
    assert query.awaitTermination(60)
    rows = stats.read_stats(lake).select("total_queries").unionByName(stats.open_windows(spark, str(tmp_path / "cp")).select("total_queries"))
    assert rows.agg(F.sum("total_queries")).first()[0] == 10
    with pytest.raises(ValueError):
        stats.start_stats(stream, lake, str(tmp_path / "cp2"), NOW, max_days=0)


def test_scoring_needs_a_model_and_picks_up_a_new_one(spark, lake, log, tmp_path):
    folder = tmp_path / "in"
    day1, day2 = (log.where(F.to_date("arrival_timestamp") == F.lit(f"2024-01-0{d}").cast("date")) for d in (1, 2))
    published = []
    loose = AnomalyThresholds(min_long_ms=1.0, underestimate_ratio=1.0, underestimate_delta_ms=1.0)

    def run():
        source = spark.readStream.schema(log.schema).parquet(str(folder))
        query = scoring.start_scoring(
            source, lake, str(tmp_path / "cp"), NOW, t=loose, publish=lambda rows: published.append(kafka.as_messages(rows).count())
        )
        query.awaitTermination()

    day1.write.mode("append").parquet(str(folder))
    run()
    assert not lake.exists(ANOMALIES_TABLE)
    fitted = models.train_on(log, models.ModelConfig(max_iter=1))
    registry.register(lake, fitted, date(2024, 1, 1))
    day2.write.mode("append").parquet(str(folder))
    run()
    expected = scoring.detect(fitted, day2, loose)
    found = lake.read(ANOMALIES_TABLE)
    assert found.count() == expected.count() == published[0] > 0
    assert found.select(*S.ANOMALIES.names).where("window_start > arrival_timestamp").count() == 0


def test_kafka_options_and_messages(spark):
    options = kafka.source_options("host:9092", "events", "earliest", 100)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        kafka.source_options("h", "t", "middle")
    df = spark.createDataFrame([(5, datetime(2024, 1, 1, 2, 3, 4), None)], "instance_id long, at timestamp, x int")
    row = kafka.as_messages(df).first()
    assert row["key"] == "5"
    assert json.loads(row["value"]) == {"instance_id": 5, "at": "2024-01-01T02:03:04.000000Z"}
    assert kafka.as_messages(df, key="none").first()["key"] is None
