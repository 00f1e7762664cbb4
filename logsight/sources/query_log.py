"""Query log derived from a generic ``events`` table.

The derivation uses whole-number arithmetic only, so every engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def query_log_from_events(events: DataFrame) -> DataFrame:
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.round(F.col("value") * 100).cast("long").alias("v100"),
    )
    e, k, v = F.col("event_id"), F.col("k"), F.col("v100")

    def floor_div(col: str, n: int):
        return F.expr(f"{col} div {n}")

    purchase = F.when(k < 30, "COPY").when(k < 40, "unload").otherwise("analyze")
    kind = (
        F.when(F.col("event_type").isin("view", "error"), "select")
        .when(F.col("event_type") == "click", "insert")
        .when(F.col("event_type") == "signup", "update")
        .when(F.col("event_type") == "purchase", purchase)
    )
    queue = (
        F.when(e % 9 == 0, F.lit(0).cast("long"))
        .when(e % 9 == 1, v * 20)
        .when(e % 9 == 2, v * 2)
        .otherwise(v % 700)
    )
    execution = F.when(k % 10 == 0, v * 40).when(k % 10 < 4, v).otherwise(floor_div("v100", 20))
    scanned = (
        F.when(e % 6 == 1, F.lit(0).cast("long"))
        .when(e % 6 == 2, floor_div("v100", 50))
        .when(e % 6 == 3, v * 20)
        .when(e % 6 == 4, v * 900)
        .when(e % 6 == 5, v)
    )
    fingerprint = F.concat(F.lit("fp"), ((F.col("user_id") * 31 + k) % 97).cast("string"))
    return base.select(
        (F.col("user_id") % 10).alias("instance_id"),
        "user_id",
        (e % 7).alias("database_id"),
        e.alias("query_id"),
        kind.alias("query_type"),
        F.col("ts").alias("arrival_timestamp"),
        F.when(e % 5 != 0, 2 + 2 * (F.col("user_id") % 10)).alias("cluster_size"),
        F.when(e % 11 != 0, fingerprint).alias("feature_fingerprint"),
        F.when(k % 4 == 1, "").when(k % 4 == 2, "12").when(k % 4 == 3, "12,34,56").alias("read_table_ids"),
        F.when(F.col("event_type") == "click", "7").alias("write_table_ids"),
        (k % 3).alias("num_permanent_tables_accessed"),
        (e % 2).alias("num_external_tables_accessed"),
        F.lit(0).cast("long").alias("num_system_tables_accessed"),
        (k % 5).alias("num_joins"),
        (e % 4).alias("num_scans"),
        (floor_div("k", 5) % 4).alias("num_aggregations"),
        F.when(k % 8 != 0, k * 7).alias("compile_duration_ms"),
        execution.alias("execution_duration_ms"),
        queue.alias("queue_duration_ms"),
        scanned.alias("mbytes_scanned"),
        F.when(e % 13 == 0, v).otherwise(F.lit(0).cast("long")).alias("mbytes_spilled"),
        (e % 23 == 0).alias("was_aborted"),
        (e % 17 == 0).alias("was_cached"),
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_log_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def fixture_predictions(log: DataFrame) -> DataFrame:
    """Arithmetic stand-in for model predictions, for exact checks of ranks and flags."""
    ms, q = F.col("execution_duration_ms"), F.col("query_id") % 4
    guess = (
        F.when(q == 0, F.expr("execution_duration_ms div 12"))
        .when(q == 1, ms - 130000)
        .when(q == 2, ms)
        .otherwise(F.lit(70000).cast("long"))
    )
    return log.where(~F.col("was_aborted")).withColumn(
        "pred_execution_ms", F.greatest(guess.cast("double"), F.lit(1.0))
    )
