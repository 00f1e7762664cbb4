"""Windowed statistics as a stream: one row per closed window and instance, late events beside them.

Every instance has a clock of its own, its newest event. A window of an instance closes when that clock is past
its end by a delay; events that come for a closed window go to a table of late events, so that every event is
counted or kept. What is open is a table of partial sums, one row per open window and instance, in the
checkpoint: each batch reads the state of the one before and writes its own, so a replayed batch replaces
itself. Events are summed before they meet the state; a busy instance costs one row per window and batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.functions.classify import ClassThresholds
from logsight.operators.windows import DEFAULT_WIDTH, add_partials, window_partials
from logsight.scratch import Scratch, delete_folder, folders_in
from logsight.sources.store import MINUTE_STATS_TABLE, Lakehouse, enforce_retention, run_id
from logsight.streaming.limits import start_batches

#: How long a window stays open past its instance's newest event.
DELAY = "1 hour"
#: An instance that lags further than this behind the newest event of all is taken to have gone silent.
IDLE = "1 day"
LATE_TABLE = "late_events"
COUNTS_TABLE = "stream_counts"

INSTANCES = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("closed_to", T.TimestampType()),
        T.StructField("size", T.LongType()),
    ]
)
OPEN = T.StructType(
    [
        *S.MINUTE_STATS.fields,
        T.StructField("size_at", T.StructType([T.StructField(S.TIME, T.TimestampType()), T.StructField("query_id", T.LongType())])),
        T.StructField("newest", T.TimestampType()),
    ]
)


class WindowState:
    """Open windows and clocks after each batch, as tables in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, batch_id: int, table: str) -> str:
        return f"{self.folder}/{batch_id}/{table}"

    def before(self, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(open windows, instances) after the last batch before this one."""
        done = [int(n) for n in folders_in(self.spark, self.folder) if n.isdigit() and int(n) < batch_id]
        if not done:
            return self.spark.createDataFrame([], OPEN), self.spark.createDataFrame([], INSTANCES)
        last = max(done)
        return tuple(self.spark.read.schema(s).parquet(self._path(last, t)) for t, s in (("open", OPEN), ("instances", INSTANCES)))

    def write(self, batch_id: int, open_: DataFrame, instances: DataFrame) -> None:
        for table, rows, schema in (("open", open_, OPEN), ("instances", instances, INSTANCES)):
            rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(self._path(batch_id, table))

    def forget(self) -> None:
        """Drop all states but the last two: a batch only begins when the one before it is done."""
        done = sorted(int(n) for n in folders_in(self.spark, self.folder) if n.isdigit())
        for n in done[:-2]:
            delete_folder(self.spark, f"{self.folder}/{n}")


def _passed(closed_to: Column, width: str, delay: str) -> Column:
    """Whether a clock is past a window's end by the delay."""
    return F.col("window_start") + F.expr(f"interval {width}") + F.expr(f"interval {delay}") <= closed_to


def late_pairs(fresh: DataFrame, instances: DataFrame, width: str, delay: str) -> DataFrame:
    """Rows of windows and instances that were closed before."""
    known = fresh.join(instances.select("instance_id", "closed_to"), "instance_id")
    return known.where(_passed(F.col("closed_to"), width, delay)).select(*fresh.columns)


def advance(
    fresh: DataFrame, open_: DataFrame, instances: DataFrame, width: str = DEFAULT_WIDTH, delay: str = DELAY, idle: str = IDLE
) -> tuple[DataFrame, DataFrame]:
    """(all windows open so far with `ready` and their instance's `known` size, instances) after a batch's partials.

    An instance's clock is its newest event, or the newest of all less `idle` if that is later.
    """
    clocks = fresh.groupBy("instance_id").agg(F.max("newest").alias("now"))
    merged = clocks.join(instances, "instance_id", "full")
    merged = merged.withColumn("newest", F.greatest("newest", "now"))
    newest = merged.agg(F.max("newest")).first()[0]
    clock = F.greatest("newest", F.lit(newest) - F.expr(f"interval {idle}"), "closed_to")
    merged = merged.withColumn("closed_to", clock).select(*INSTANCES.names)
    windows = add_partials(open_.unionByName(fresh))
    known = merged.select("instance_id", "closed_to", F.col("size").alias("known"))
    windows = windows.join(known, "instance_id").withColumn("ready", _passed(F.col("closed_to"), width, delay))
    return windows.drop("closed_to"), merged


def filled(ready: DataFrame) -> DataFrame:
    """Closed windows; a missing cluster size is the instance's last known one, else -1."""
    past = Window.partitionBy("instance_id").orderBy("window_start")  # one row per window
    own = F.last("cluster_size", ignorenulls=True).over(past)
    size = F.coalesce(own, "known", F.lit(S.UNKNOWN_CLUSTER_SIZE).cast("long"))
    return ready.withColumn("cluster_size", size).select(*S.MINUTE_STATS.names)


def start_stats(
    events: DataFrame,
    lake: Lakehouse,
    checkpoint: str,
    trigger: dict,
    width: str = DEFAULT_WIDTH,
    delay: str = DELAY,
    idle: str = IDLE,
    keep_days: int | None = None,
    archive: str | None = None,
    t: ClassThresholds = ClassThresholds(),
    max_days: int | None = None,
):
    """Write closed windows, late events and counts of both; a replayed batch replaces itself.

    With ``keep_days`` only that many of the latest days stay; older ones move to ``archive``.
    """
    spark = lake.spark
    run = run_id(spark, checkpoint)
    state = WindowState(spark, f"{checkpoint.rstrip('/')}/windows")
    newest: list = [None]

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        with Scratch(spark) as keep:
            open_, instances = state.before(batch_id)
            fresh = keep(window_partials(batch, width, t), "fresh")
            late = keep(late_pairs(fresh, instances, width, delay), "late")
            on_time = fresh.join(late.select("window_start", "instance_id"), ["window_start", "instance_id"], "left_anti")
            windows, clocks = advance(on_time.select(*fresh.columns), open_, instances, width, delay, idle)
            windows, clocks = keep(windows, "windows"), keep(clocks, "clocks")
            closed = windows.where("ready")
            lake.replace_batch(MINUTE_STATS_TABLE, filled(closed), batch_id, "window_start", run)
            counts = late.agg(F.coalesce(F.sum("total_queries"), F.lit(0)).alias("rows_late")).first()
            if counts["rows_late"]:
                lake.replace_batch(LATE_TABLE, late_rows(batch, late, width), batch_id, "window_start", run)
            about = fresh.agg(
                F.current_timestamp().alias("at"), F.sum("total_queries").alias("rows_in"), F.lit(counts["rows_late"]).alias("rows_late")
            ).crossJoin(windows.agg(F.count_if("ready").alias("windows_closed"), F.count_if(~F.col("ready")).alias("windows_open")))
            lake.replace_batch(COUNTS_TABLE, about, batch_id, "at", run)
            last = closed.where("cluster_size is not null").groupBy("instance_id")
            sizes = last.agg(F.max_by("cluster_size", "window_start").alias("last"))
            sized = clocks.join(sizes, "instance_id", "left").withColumn("size", F.coalesce("last", "size"))
            state.write(batch_id, windows.where(~F.col("ready")), sized)
        state.forget()
        day = batch.agg(F.max(F.to_date(S.TIME))).first()[0] if keep_days else None
        if day is not None and day != newest[0]:  # days only leave when one is added
            newest[0] = day
            enforce_retention(lake, MINUTE_STATS_TABLE, keep_days, archive or lake.path("archive"))

    return start_batches(events, write, checkpoint, trigger, max_days)


def late_rows(batch: DataFrame, late: DataFrame, width: str) -> DataFrame:
    """The events of late windows, with the window that they came too late for."""
    pairs = late.select("window_start", F.col("instance_id").alias("_instance"))
    named = batch.select(
        F.window(S.TIME, width).start.alias("window_start"),
        F.coalesce("instance_id", F.lit(S.UNKNOWN_INSTANCE)).alias("_instance"), *batch.columns,
    )
    return named.join(pairs, ["window_start", "_instance"], "left_semi").drop("_instance")


def late_schema(events: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("window_start", T.TimestampType()), *events.fields])


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stream has not closed yet."""
    return WindowState(spark, f"{checkpoint.rstrip('/')}/windows").before(1 << 62)[0].select(*S.MINUTE_STATS.names)


def read_stats(lake: Lakehouse) -> DataFrame:
    """The statistics table with its partition column ``day``, by which reports prune."""
    stored = lake.read(MINUTE_STATS_TABLE, S.MINUTE_STATS)
    if "day" not in stored.columns:  # no window has been written yet
        stored = stored.withColumn("day", F.to_date("window_start"))
    return stored.select(*S.MINUTE_STATS.names, "day")
