"""Reporting queries over the windowed statistics and the anomalies."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.functions.values import ratio

# Report periods by name.
PERIODS = {"24h": timedelta(hours=24), "24 h": timedelta(hours=24), "1week": timedelta(days=7), "1 week": timedelta(days=7)}

# When an instance or a problem type counts as critical.
CRITICAL_COUNT = 50
CRITICAL_SHARE = 0.05


@dataclass(frozen=True)
class TimeWindow:
    """Frozen bounds of one report: current rows are at or after ``start``."""

    start: datetime
    previous_start: datetime

    def current(self, ts: str = "window_start") -> Column:
        return F.col(ts) >= F.lit(self.start)

    def previous(self, ts: str = "window_start") -> Column:
        return (F.col(ts) >= F.lit(self.previous_start)) & (F.col(ts) < F.lit(self.start))

    def both(self, ts: str = "window_start") -> Column:
        return F.col(ts) >= F.lit(self.previous_start)


def period_length(period: str) -> timedelta:
    if period not in PERIODS:
        raise NotImplementedError(f"unknown report period {period!r}")
    return PERIODS[period]


def time_window_table(stats: DataFrame, period: str) -> DataFrame:
    """One row with the latest window and the bounds of the period ending there."""
    seconds = int(period_length(period).total_seconds())
    back = F.make_dt_interval(secs=F.lit(seconds))
    latest = stats.agg(F.max("window_start").alias("latest"))
    return latest.select(
        "latest",
        (F.col("latest") - back).alias("window_start"),
        (F.col("latest") - back - back).alias("prev_window_start"),
    )


def time_window(stats: DataFrame, period: str) -> TimeWindow:
    """The bounds as values: a report prunes partitions by them. An empty table ends now."""
    length = period_length(period)
    latest = stats.agg(F.max(F.unix_micros("window_start"))).first()[0]
    if latest is None:
        end = datetime.now(timezone.utc)
    else:
        end = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=latest)
    return TimeWindow(end - length, end - 2 * length)


def recent(df: DataFrame, since: datetime) -> DataFrame:
    """Only the day partitions that can hold rows since then, where a table has such partitions.

    A window may start the day before the event it holds, hence one day more.
    """
    if "day" not in df.columns:
        return df
    return df.where(F.col("day") >= F.lit((since - timedelta(days=1)).date()))


def for_instances(df: DataFrame, ids: list[int] | DataFrame | None) -> DataFrame:
    """Rows of the given instances; ids are a list or a one-column frame, None means all."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select("instance_id").distinct(), "instance_id", "left_semi")
    return df.where(F.col("instance_id").isin([int(i) for i in ids]))


def parse_ids(text: str) -> list[int]:
    """Whole-number ids of a comma-separated list; blanks are skipped."""
    return [int(p) for p in text.split(",") if p.strip()]


def instance_ids(stats: DataFrame, tw: TimeWindow) -> DataFrame:
    return recent(stats, tw.start).where(tw.current()).select("instance_id").distinct().orderBy("instance_id")


def _per_instance(stats: DataFrame, tw: TimeWindow) -> DataFrame:
    sums = [F.sum(f"{p}_queries").alias(p) for p in S.PROBLEM_TYPES]
    total = F.sum("total_queries").alias("total")
    return recent(stats, tw.start).where(tw.current()).groupBy("instance_id").agg(total, *sums)


def _is_critical(problem: str, count: int, share: float) -> Column:
    over = (F.col(problem) > count) | (ratio(F.col(problem), F.col("total")) > share)
    return F.coalesce(over, F.lit(False))


def critical_instances(
    stats: DataFrame, tw: TimeWindow, count: int = CRITICAL_COUNT, share: float = CRITICAL_SHARE
) -> DataFrame:
    """Instances where some problem type exceeds the count or the share."""
    any_critical = F.lit(False)
    for p in S.PROBLEM_TYPES:
        any_critical = any_critical | _is_critical(p, int(count), float(share))
    return _per_instance(stats, tw).where(any_critical).select("instance_id").orderBy("instance_id")


def critical_problem_types(
    stats: DataFrame,
    tw: TimeWindow,
    ids: list[int] | DataFrame | None = None,
    count: int = CRITICAL_COUNT,
    share: float = CRITICAL_SHARE,
) -> DataFrame:
    """Problem types critical in at least one of the instances, most severe first; one scan."""
    per_instance = _per_instance(for_instances(stats, ids), tw)
    found = per_instance.agg(
        *[F.bool_or(_is_critical(p, int(count), float(share))).alias(p) for p in S.PROBLEM_TYPES]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("severity"), F.lit(p).alias("problem"), F.col(p).alias("critical"))
            for i, p in enumerate(S.PROBLEM_TYPES)
        ]
    )
    return (
        found.select(F.inline(rows))
        .where(F.coalesce(F.col("critical"), F.lit(False)))
        .orderBy("severity")
        .select("problem")
    )


def critical_problem_types_by_union(
    stats: DataFrame,
    tw: TimeWindow,
    ids: list[int] | DataFrame | None = None,
    count: int = CRITICAL_COUNT,
    share: float = CRITICAL_SHARE,
) -> DataFrame:
    """The same as a union of one select per type; kept to show that both agree."""
    per_instance = _per_instance(for_instances(stats, ids), tw)
    parts = [
        per_instance.where(_is_critical(p, int(count), float(share))).select(F.lit(p).alias("problem"))
        for p in S.PROBLEM_TYPES
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.distinct()


def _metric_columns(rows: Column) -> dict[str, Column]:
    """Fleet metrics over the rows where the condition holds, computed in one pass with others."""

    def total(name: str) -> Column:
        return F.sum(F.when(rows, F.col(name)))

    queue, execution = total("total_queue_time_ms"), total("total_exec_time_ms")
    return {
        "cluster_size": F.min(F.when(rows, F.col("cluster_size"))).cast("double"),
        "score": ratio(total("normal_queries"), total("total_queries")),
        "spilled_mb": total("total_spilled_mb"),
        "queue_time": queue,
        "queue_ratio": ratio(queue, queue + execution),
    }


# The fleet metrics in report order.
METRICS = ("cluster_size", "score", "spilled_mb", "queue_time", "queue_ratio", "anomalies_count")


def anomaly_count(anomalies: DataFrame, tw: TimeWindow, ids: list[int] | DataFrame | None = None) -> DataFrame:
    """Anomalies of the current and the previous window by arrival time."""
    rows = recent(for_instances(anomalies, ids), tw.previous_start).where(tw.both(S.TIME))
    return rows.agg(
        F.count_if(tw.current(S.TIME)).alias("anomalies_count"),
        F.count_if(tw.previous(S.TIME)).alias("anomalies_prev"),
    )


def fleet_metrics(
    stats: DataFrame, anomalies: DataFrame, tw: TimeWindow, ids: list[int] | DataFrame | None = None
) -> DataFrame:
    """One row: each metric of the current window and its change against the previous one.

    Both windows come from one scan by conditional aggregation; missing values read as zero.
    """
    current = _metric_columns(tw.current())
    previous = _metric_columns(tw.previous())
    row = recent(for_instances(stats, ids), tw.previous_start).where(tw.both()).agg(
        *[c.alias(n) for n, c in current.items()],
        *[c.alias(f"{n}_prev") for n, c in previous.items()],
    )
    counted = anomaly_count(anomalies, tw, ids)
    row = row.withColumns(
        {
            "anomalies_count": counted.select(F.col("anomalies_count").cast("double")).scalar(),
            "anomalies_count_prev": counted.select(F.col("anomalies_prev").cast("double")).scalar(),
        }
    )

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    out = []
    for m in METRICS:
        out += [known(m).alias(m), (known(m) - known(f"{m}_prev")).alias(f"{m}_delta")]
    return row.select(*out)


def anomaly_details(anomalies: DataFrame, tw: TimeWindow, ids: list[int] | DataFrame | None = None) -> DataFrame:
    return recent(for_instances(anomalies, ids), tw.start).where(tw.current(S.TIME)).select(
        "instance_id",
        "arrival_timestamp",
        "query_id",
        "user_id",
        "database_id",
        "anomaly_reason",
        F.col("signed_err_ms").alias("absolute_delta"),
        F.col("under_ratio").alias("relative_delta"),
    )


def class_chart(stats: DataFrame, tw: TimeWindow, ids: list[int] | DataFrame | None = None) -> DataFrame:
    """Class counts per window over time."""
    rows = recent(for_instances(stats, ids), tw.start).where(tw.current())
    return rows.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in S.CLASSES]).orderBy("window_start")


def class_shares(chart: DataFrame) -> DataFrame:
    """Each class as a percentage of its window; an empty window is all zeros."""
    total = F.lit(0)
    for c in S.CLASSES:
        total = total + F.coalesce(F.col(c), F.lit(0))
    share = {
        c: F.coalesce(ratio(F.coalesce(F.col(c), F.lit(0)), total), F.lit(0.0)) * 100 for c in S.CLASSES
    }
    return chart.select("window_start", *[v.alias(c) for c, v in share.items()])


def class_totals(
    stats: DataFrame, anomalies: DataFrame, tw: TimeWindow, ids: list[int] | DataFrame | None = None
) -> DataFrame:
    """One row: totals and fractions per class and of the anomalies.

    A window with anomalies but no queries has no fraction; one with neither has zero.
    """
    rows = recent(for_instances(stats, ids), tw.start).where(tw.current())
    sums = rows.agg(F.sum("total_queries").alias("total_queries"), *[F.sum(c).alias(c) for c in S.CLASSES])
    counted = anomaly_count(anomalies, tw, ids).select("anomalies_count").scalar()
    total, found = F.coalesce(F.col("total_queries"), F.lit(0)), F.col("anomalies_count")
    pct = F.when(total > 0, ratio(found, total)).when(found == 0, F.lit(0.0))
    fractions = [
        c
        for name in S.CLASSES
        for c in (F.col(name), ratio(F.col(name), F.col("total_queries")).alias(f"{name}_pct"))
    ]
    return sums.withColumn("anomalies_count", counted).select(
        "total_queries", *fractions, "anomalies_count", pct.alias("anomalies_pct")
    )


# Labels of the totals table in display order.
TOTAL_ROWS = (
    ("Total", "total_queries"),
    ("Normal", "normal_queries"),
    ("CPU", "cpu_bound_queries"),
    ("IO", "io_bound_queries"),
    ("Network", "network_bound_queries"),
    ("Queue/WLM", "queue_wlm_bound_queries"),
    ("Anomalies", "anomalies_count"),
)


def totals_as_rows(totals: DataFrame) -> DataFrame:
    """The one-row totals turned into (type, count, pct) rows; the total itself is 1."""

    def entry(label: str, name: str) -> Column:
        pct = F.lit(1.0) if name == "total_queries" else F.col(name.removesuffix("_count") + "_pct")
        return F.struct(F.lit(label).alias("type"), F.col(name).cast("long").alias("count"), pct.alias("pct"))

    return totals.select(F.inline(F.array(*[entry(label, name) for label, name in TOTAL_ROWS])))


def training_profile(log: DataFrame) -> DataFrame:
    """Size of a training set: rows, days and distinct fingerprints."""
    fp = F.coalesce(F.col("feature_fingerprint"), F.lit(S.MISSING_CATEGORY))
    return log.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.to_date(S.TIME)).alias("days"),
        F.count_distinct(fp).alias("fingerprints"),
    )
