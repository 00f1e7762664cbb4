"""Plans have the shape the results are meant to be computed with."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from logsight.operators.anomaly import anomalies
from logsight.operators.lookup import lookup
from logsight.operators.order_stats import exact_quantiles
from logsight.operators.windows import minute_stats
from logsight.plans import regimes, report
from logsight.scratch import materialise
from logsight.sources import files
from logsight.sources.query_log import fixture_predictions
from logsight.sources.store import Lakehouse, write_stats


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_rows_are_shuffled_by_salt(spark, no_broadcast):
    rows = spark.range(100).withColumn("k", F.lit("hot"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.first("k").alias("v"))
    assert "hashpartitioning(_salt" in plan(lookup(rows, table, ["k"], "n", ["id"]))


def test_quantiles_shuffle_rows_once(log, no_broadcast):
    """Where places are too many to broadcast, rows are read and shuffled once, spread by their buckets."""
    df = exact_quantiles(log, ["instance_id"], {"x": F.col("execution_duration_ms")}, [0.5])
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 2  # the log and the places
    assert re.search(r"hashpartitioning\(_k#\d+, measure#\d+, _bucket#\d+", final)


def test_windows_combine_before_the_shuffle(log):
    text = plan(minute_stats(log))
    assert "partial_count" in text and "partial_max_by" in text
    assert "read_table_ids" not in text.split("ReadSchema")[1]


def test_day_range_is_pushed_down(spark, sf_dir):
    text = plan(files.read_day(spark, f"{sf_dir}/events.parquet", date(2024, 1, 10), ["event_id", "ts"], ts="ts"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_only_long_rows_are_read_for_flags(log):
    text = plan(anomalies(materialise(fixture_predictions(log), "predicted")))
    assert "GreaterThanOrEqual(execution_duration_ms,60000)" in text


def test_reports_prune_days(spark, lake, log):
    write_stats(lake, minute_stats(log, "1 hour"))
    stats = Lakehouse(spark, lake.root, lake.name).read("minute_stats")
    text = plan(report.class_chart(stats, report.time_window(stats, "24h")))
    assert "PartitionFilters: [isnotnull(day" in text


def test_sensitivity_scans_once(log):
    assert plan(regimes.sensitivity(log)).count("FileScan") == 1
