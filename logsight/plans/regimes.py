"""Where behaviour changes along a measure, and how well the class rules fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsight.functions.classify import (
    CPU,
    IO,
    NETWORK,
    QUEUE,
    ClassThresholds,
    Measures,
    class_conditions,
    query_class,
)
from logsight.functions.values import ratio
from logsight.operators.order_stats import exact_quantiles, with_quantiles

# Bucket edges of each profile (a bucket runs from its edge to the next).
RATIO_EDGES = (0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 500.0)
SCAN_EDGES = (0, 200, 500, 1000, 2000, 5000, 10000, 50000, 100000)
TRANSFER_EDGES = (0, 50, 200, 500, 1000, 5000)
QUEUE_EDGES = (0, 500, 1000, 2000, 5000, 10000)

M = Measures()


def bucket_start(col: Column, edges: Sequence[float]) -> Column:
    """The largest edge not above the value."""
    out = F.lit(float(edges[0]))
    for e in edges[1:]:
        out = F.when(col >= e, F.lit(float(e))).otherwise(out)
    return out


def _share(cond: Column) -> Column:
    """Percentage of the group's rows for which the condition holds."""
    return F.count_if(cond) * F.lit(100.0) / F.count(F.lit(1))


def _mean(col: Column) -> Column:
    """Average of a whole-number measure from its exact sum."""
    return ratio(F.sum(col), F.count(F.lit(1)))


def _scanning(log: DataFrame) -> DataFrame:
    return log.where(~M.cached & ~M.transfer & (M.scanned > 0))


def ratio_profile(log: DataFrame) -> DataFrame:
    """Multi-operator queries by execution ms per scanned MB."""
    complex_scans = _scanning(log).where(M.joins + M.aggs > 1)
    buckets = complex_scans.groupBy(bucket_start(M.scan_ratio, RATIO_EDGES).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(M.exec_ms).alias("exec_sum"),
        _share(M.spilled > 0).alias("spill_pct"),
        _share(M.queue_ms >= M.exec_ms).alias("queue_dominant_pct"),
    )
    everything = Window.partitionBy()  # a handful of buckets
    overall = ratio(F.sum("exec_sum").over(everything), F.sum("n").over(everything))
    avg = ratio(F.col("exec_sum"), F.col("n"))
    return buckets.select(
        "bucket", "n", "spill_pct", "queue_dominant_pct", avg.alias("avg_exec_ms"), (avg / overall).alias("vs_overall")
    )


def scan_profile(log: DataFrame) -> DataFrame:
    """Scanning queries by scanned volume."""
    rows = _scanning(log).withColumn("bucket", bucket_start(M.scanned, SCAN_EDGES))
    buckets = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        _share(M.spilled > 0).alias("spill_pct"),
        _share(M.scans > 1).alias("multi_scan_pct"),
        _mean(M.spilled).alias("avg_spill_mb"),
    )
    return with_quantiles(buckets, rows, ["bucket"], {"ratio_p50": M.scan_ratio})


def transfer_profile(log: DataFrame) -> DataFrame:
    """Loads and unloads by duration."""
    rows = log.where(~M.cached & M.transfer).select(
        F.lower("query_type").alias("query_type"),
        bucket_start(M.exec_ms, TRANSFER_EDGES).alias("bucket"),
        M.scanned.alias("scanned"),
    )
    keys = ["query_type", "bucket"]
    buckets = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), _mean(F.col("scanned")).alias("avg_scan_mb")
    )
    return with_quantiles(buckets, rows, keys, {"scan_p50_mb": F.col("scanned")})


def queue_profile(log: DataFrame) -> DataFrame:
    """Queued queries by time in the queue."""
    queued = log.where((M.queue_ms > 0) & (M.exec_ms > 0))
    buckets = queued.groupBy(bucket_start(M.queue_ms, QUEUE_EDGES).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        _mean(M.queue_ms).alias("avg_queue_ms"),
        _mean(M.exec_ms).alias("avg_exec_ms"),
        _share(M.queue_ms >= M.exec_ms).alias("queue_dominant_pct"),
    )
    return buckets.withColumn("queue_per_exec", F.col("avg_queue_ms") / F.col("avg_exec_ms"))


def transitions(log: DataFrame) -> DataFrame:
    """First bucket past the turning point of each profile.

    Execution: average at least twice the overall one. Transfers: median scan of at least 50 MB.
    """
    slow = ratio_profile(log).where(F.col("vs_overall") >= 2.0).agg(F.min("bucket").alias("bucket"))
    moving = (
        transfer_profile(log)
        .where(F.col("scan_p50_mb") >= 50)
        .groupBy("query_type")
        .agg(F.min("bucket").alias("bucket"))
    )
    return slow.select(F.lit("ratio").alias("profile"), "bucket").unionByName(
        moving.select(F.concat(F.lit("transfer_"), "query_type").alias("profile"), "bucket")
    )


def class_distribution(log: DataFrame) -> DataFrame:
    """Every class: size, share and typical behaviour."""
    rows = log.withColumn("query_class", query_class())
    summary = rows.groupBy("query_class").agg(
        F.count(F.lit(1)).alias("n"),
        _mean(M.scanned).alias("avg_scan_mb"),
        _share(M.spilled > 0).alias("spill_pct"),
        _share(M.queue_ms >= M.exec_ms).alias("queue_dominant_pct"),
        _mean(M.complexity).alias("avg_complexity"),
    )
    pct = F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy())  # five classes
    scanned_ratio = F.when(M.scanned > 0, M.scan_ratio)
    medians = {"exec_p50_ms": M.exec_ms, "ratio_p50": scanned_ratio}
    return with_quantiles(summary.withColumn("pct", pct), rows, ["query_class"], medians)


def purity_conditions(t: ClassThresholds = ClassThresholds()) -> dict[str, Column]:
    """What a typical member of each class looks like beyond its rule."""
    return {
        CPU: (M.spilled <= 0) & (M.queue_ms < M.exec_ms) & (M.complexity > 1),
        IO: (M.scanned >= t.io_scanned_mb) & ((M.spilled > 0) | (M.scans > 1)),
        NETWORK: M.transfer & (M.exec_ms > t.network_exec_ms),
        QUEUE: (M.queue_ms >= M.exec_ms) & (M.queue_ms > t.queue_ms),
    }


def class_purity(log: DataFrame) -> DataFrame:
    """Share of each class's queries that show all its expected traits."""
    pure = F
    for name, cond in purity_conditions().items():
        pure = pure.when(F.col("query_class") == name, cond)
    slow_complex = (M.exec_ms > 1000) & (M.complexity > 1)
    rows = log.withColumn("query_class", query_class()).where(F.col("query_class") != "normal_queries")
    return rows.groupBy("query_class").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(pure).alias("pure"),
        _share(pure).alias("purity_pct"),
        _share(slow_complex).alias("slow_complex_pct"),
    )


def class_overlap(log: DataFrame) -> DataFrame:
    """How many queries satisfy two rules at once when order is ignored."""
    rule = class_conditions()
    pairs = [("cpu_io", CPU, IO), ("cpu_queue", CPU, QUEUE), ("io_queue", IO, QUEUE), ("network_queue", NETWORK, QUEUE)]
    counts = log.agg(*[F.count_if(rule[a] & rule[b]).alias(name) for name, a, b in pairs])
    rows = F.array(*[F.struct(F.lit(n).alias("pair"), F.col(n).alias("n")) for n, _, _ in pairs])
    return counts.select(F.inline(rows))


# Factors of the sensitivity run.
SENSITIVITY = (("minus20", 0.8), ("base", 1.0), ("plus20", 1.2))


def sensitivity(log: DataFrame) -> DataFrame:
    """Class shares with all measured thresholds 20 % lower and higher; one scan for all three."""
    variants = F.array(
        *[
            F.struct(F.lit(name).alias("variant"), query_class(ClassThresholds().scaled(f)).alias("query_class"))
            for name, f in SENSITIVITY
        ]
    )
    counts = log.select(F.inline(variants)).groupBy("variant", "query_class").agg(F.count(F.lit(1)).alias("n"))
    per_variant = F.sum("n").over(Window.partitionBy("variant"))  # five classes
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / per_variant)


def cpu_variants(log: DataFrame, t: ClassThresholds = ClassThresholds()) -> DataFrame:
    """The CPU rule with and without a scan range and a minimum duration; one scan."""
    base = ~M.cached & ~M.transfer & ((M.joins > 1) | (M.aggs > 1)) & (M.scanned > 0) & (M.scan_ratio > t.cpu_ratio)
    in_range = (M.scanned >= 5) & (M.scanned <= 434)
    slow = M.exec_ms > t.cpu_exec_ms
    rules = {"A": base & in_range, "B": base, "C": base & slow, "D": base & in_range & slow}
    members = F.array_compact(F.array(*[F.when(c, F.lit(v)) for v, c in rules.items()]))
    pure = (M.spilled <= 0) & (M.queue_ms < M.exec_ms) & (M.complexity > 1)
    total = log.agg(F.count(F.lit(1)).alias("t")).scalar()
    grouped = (
        log.withColumn("variant", F.explode(members))
        .groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("n"),
            _share(pure).alias("purity_pct"),
            _mean(M.exec_ms).alias("avg_exec_ms"),
            _mean(M.complexity).alias("avg_complexity"),
            _share(M.spilled > 0).alias("spill_pct"),
        )
    )
    return grouped.withColumn("pct", F.col("n") * F.lit(100.0) / total)


def ratio_ceiling(log: DataFrame, t: ClassThresholds = ClassThresholds()) -> DataFrame:
    """Average over large-scan buckets of the lower-quartile ratio: the IO rule's ceiling."""
    rows = _scanning(log).where(M.scanned >= t.io_scanned_mb).select(
        bucket_start(M.scanned, SCAN_EDGES).alias("bucket"), M.scan_ratio.alias("r")
    )
    p25 = exact_quantiles(rows, ["bucket"], {"r": F.col("r")}, [0.25])
    return p25.agg(F.avg("r_q0").alias("ratio_ceiling"), F.count(F.lit(1)).alias("buckets"))
