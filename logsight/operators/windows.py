"""Event-time windows per instance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.functions.classify import ClassThresholds, query_class

DEFAULT_WIDTH = "10 minutes"


def _sum(name: str) -> Column:
    return F.sum(F.coalesce(F.col(name), F.lit(0)))


def usable_size(col: Column) -> Column:
    """Cluster size as a whole number; NaN and text that is no number count as missing."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("long"))


SUMS = ["total_queries", *S.CLASSES, "total_spilled_mb", "total_queue_time_ms", "total_exec_time_ms"]


def window_partials(
    events: DataFrame, width: str = DEFAULT_WIDTH, t: ClassThresholds = ClassThresholds()
) -> DataFrame:
    """Per window and instance: class counts, sums, the last cluster size with its place, the newest event.

    Rows of one window and instance from several batches of events add up, see :func:`add_partials`.
    Everything is a partial aggregate, so a busy instance is combined before the shuffle.
    """
    size = usable_size(F.col("cluster_size"))
    seen_at = F.when(size.isNotNull(), F.struct(S.TIME, "query_id"))
    typed = events.withColumns(
        {
            "query_class": query_class(t),
            "instance_id": F.coalesce(F.col("instance_id"), F.lit(S.UNKNOWN_INSTANCE)),
        }
    )
    cls = F.col("query_class")
    return (
        typed.groupBy(F.window(S.TIME, width).alias("w"), "instance_id")
        .agg(
            F.max_by(size, seen_at).alias("cluster_size"),
            F.max(seen_at).alias("size_at"),
            F.max(S.TIME).alias("newest"),
            F.count(F.lit(1)).alias("total_queries"),
            *[F.count_if(cls == c).alias(c) for c in S.CLASSES],
            _sum("mbytes_spilled").cast("double").alias("total_spilled_mb"),
            _sum("queue_duration_ms").cast("double").alias("total_queue_time_ms"),
            _sum("execution_duration_ms").cast("double").alias("total_exec_time_ms"),
        )
        .select(F.col("w.start").alias("window_start"), *S.MINUTE_STATS.names[1:], "size_at", "newest")
    )


def add_partials(partials: DataFrame) -> DataFrame:
    """One row per window and instance of several partial ones."""
    return (
        partials.groupBy("window_start", "instance_id")
        .agg(
            F.max_by("cluster_size", "size_at").alias("cluster_size"),
            F.max("size_at").alias("size_at"),
            F.max("newest").alias("newest"),
            *[F.sum(c).alias(c) for c in SUMS],
        )
        .select(*partials.columns)
    )


def window_counts(
    events: DataFrame, width: str = DEFAULT_WIDTH, t: ClassThresholds = ClassThresholds()
) -> DataFrame:
    """Per window and instance: class counts, sums and the last cluster size seen, if any."""
    return window_partials(events, width, t).select(*S.MINUTE_STATS.names)


def carry_cluster_size(counts: DataFrame) -> DataFrame:
    """Windows without a cluster size take the instance's last known one, else -1.

    Runs over window rows, so a group has at most one row per window, however many queries.
    """
    past = Window.partitionBy("instance_id").orderBy("window_start")
    carried = F.last("cluster_size", ignorenulls=True).over(past)
    return counts.withColumn("cluster_size", F.coalesce(carried, F.lit(S.UNKNOWN_CLUSTER_SIZE).cast("long")))


def minute_stats(
    events: DataFrame, width: str = DEFAULT_WIDTH, t: ClassThresholds = ClassThresholds()
) -> DataFrame:
    """The windowed statistics table: class counts and resource sums per instance."""
    return carry_cluster_size(window_counts(events, width, t)).select(*S.MINUTE_STATS.names)


def fill_cluster_size(events: DataFrame, chunk: str = "1 minute") -> DataFrame:
    """Replace a missing cluster size of every event by the instance's last known one, else -1.

    Time is cut into chunks: one value per chunk is carried along the chunks of an instance (few
    rows), and only events of the same chunk are ordered together, so a busy instance is spread
    over as many groups as it has chunks.
    """
    rows = events.withColumns(
        {
            "_g": F.coalesce(F.col("instance_id"), F.lit(S.UNKNOWN_INSTANCE)),
            "_chunk": F.window(S.TIME, chunk).start,
            "_size": usable_size(F.col("cluster_size")),
        }
    )
    order = F.struct(S.TIME, "query_id")
    last_of_chunk = rows.groupBy("_g", "_chunk").agg(
        F.max_by("_size", F.when(F.col("_size").isNotNull(), order)).alias("_last")
    )
    before = Window.partitionBy("_g").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_of_chunk.select(
        "_g", "_chunk", F.last("_last", ignorenulls=True).over(before).alias("_carried")
    )
    inside = Window.partitionBy("_g", "_chunk").orderBy(S.TIME, "query_id")
    filled = F.coalesce(
        F.last("_size", ignorenulls=True).over(inside),
        F.col("_carried"),
        F.lit(S.UNKNOWN_CLUSTER_SIZE).cast("long"),
    )
    return (
        rows.join(carried, ["_g", "_chunk"], "left")
        .withColumn("cluster_size", filled)
        .select(*events.columns)
    )


def stamp_window(hits: DataFrame, width: str = DEFAULT_WIDTH, ts: str = S.TIME) -> DataFrame:
    """Give every anomaly the start of its window, without gathering a window's rows."""
    return hits.select(F.window(ts, width).start.alias("window_start"), *hits.columns)


def flatten_batches(batches: DataFrame, records: str) -> DataFrame:
    """One row per record of a list column; empty lists and NULL records vanish."""
    return (
        batches.select(F.explode(records).alias("_rec")).where(F.col("_rec").isNotNull()).select("_rec.*")
    )
