"""Column names and types of the query log and of the tables derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of a query event, in landing order.
QUERY_EVENT = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("database_id", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("arrival_timestamp", T.TimestampType()),
        T.StructField("cluster_size", T.LongType()),
        T.StructField("feature_fingerprint", T.StringType()),
        T.StructField("read_table_ids", T.StringType()),
        T.StructField("write_table_ids", T.StringType()),
        T.StructField("num_permanent_tables_accessed", T.LongType()),
        T.StructField("num_external_tables_accessed", T.LongType()),
        T.StructField("num_system_tables_accessed", T.LongType()),
        T.StructField("num_joins", T.LongType()),
        T.StructField("num_scans", T.LongType()),
        T.StructField("num_aggregations", T.LongType()),
        T.StructField("compile_duration_ms", T.LongType()),
        T.StructField("execution_duration_ms", T.LongType()),
        T.StructField("queue_duration_ms", T.LongType()),
        T.StructField("mbytes_scanned", T.DoubleType()),
        T.StructField("mbytes_spilled", T.DoubleType()),
        T.StructField("was_aborted", T.BooleanType()),
        T.StructField("was_cached", T.BooleanType()),
    ]
)

#: The same event as it arrives in JSON: everything dirty stays text until it is typed.
RAW_EVENT = T.StructType([T.StructField(f.name, T.StringType()) for f in QUERY_EVENT])

TIME = "arrival_timestamp"
TARGET = "execution_duration_ms"
INSTANCE = "instance_id"
UNKNOWN_INSTANCE = -1
UNKNOWN_CLUSTER_SIZE = -1
MISSING_CATEGORY = "NA"

# Class counters of the windowed statistics, in table order.
CLASSES = (
    "normal_queries",
    "cpu_bound_queries",
    "io_bound_queries",
    "network_bound_queries",
    "queue_wlm_bound_queries",
)

# Problem types in order of severity.
PROBLEM_TYPES = ("cpu_bound", "io_bound", "queue_wlm_bound", "network_bound")

MINUTE_STATS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("instance_id", T.LongType()),
        T.StructField("cluster_size", T.LongType()),
        T.StructField("total_queries", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in CLASSES],
        T.StructField("total_spilled_mb", T.DoubleType()),
        T.StructField("total_queue_time_ms", T.DoubleType()),
        T.StructField("total_exec_time_ms", T.DoubleType()),
    ]
)

# The fields of one anomaly hit, in table order.
ANOMALY_HIT = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("database_id", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("true_ms", T.DoubleType()),
        T.StructField("pred_ms", T.DoubleType()),
        T.StructField("pred_mean_ms", T.DoubleType()),
        T.StructField("pred_q_ms", T.DoubleType()),
        T.StructField("abs_err_ms", T.DoubleType()),
        T.StructField("signed_err_ms", T.DoubleType()),
        T.StructField("under_ratio", T.DoubleType()),
        T.StructField("anomaly_reason", T.StringType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("arrival_timestamp", T.TimestampType()),
        T.StructField("cluster_size", T.LongType()),
    ]
)

ANOMALIES = T.StructType([T.StructField("window_start", T.TimestampType()), *ANOMALY_HIT.fields])

PROCESSED_DAYS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("stage", T.StringType()),
        T.StructField("rows_scored", T.LongType()),
        T.StructField("rows_anoms", T.LongType()),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)

BOOL_COLUMNS = ("was_aborted", "was_cached")

# Model inputs known once a query is compiled.
STAGE = "postcompile"
NUMERIC_FEATURES = (
    "num_permanent_tables_accessed",
    "num_external_tables_accessed",
    "num_system_tables_accessed",
    "num_joins",
    "num_scans",
    "num_aggregations",
    "compile_duration_ms",
    "read_table_count",
    "write_table_count",
    "has_write",
    "arrival_hour",
    "arrival_dow",
    "cluster_size",
    "fp_freq",
    "fp_is_rare",
)
CATEGORICAL_FEATURES = ("query_type", "fp_bucket")
ZERO_INDICATORS = ("compile_duration_ms",)


def scoring_columns(target: str = TARGET) -> list[str]:
    """Raw columns a scoring or training run reads; everything else is pruned."""
    unused = {"queue_duration_ms", "mbytes_scanned", "mbytes_spilled"}
    names = [f.name for f in QUERY_EVENT if f.name not in unused]
    return names if target in names else [*names, target]


def backtest_columns(target: str = TARGET) -> list[str]:
    """Raw columns kept through a backtest, so anomalies carry the whole event."""
    names = [f.name for f in QUERY_EVENT] + ["cache_source_query_id"]
    return sorted({*names, target})
