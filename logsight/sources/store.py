"""Result tables of one named lakehouse: append, evolve, replace by batch, retain, look up."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.scratch import delete_folder, folders_in


@dataclass(frozen=True)
class Lakehouse:
    """A database with its tables as Parquet folders under one root."""

    spark: SparkSession
    root: str
    name: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.name}/{table}"

    def exists(self, table: str) -> bool:
        try:
            self.spark.read.format("parquet").load(self.path(table))
            return True
        except AnalysisException:
            return False

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """A table. With a schema no file is opened to find one, and an absent table is empty.

        Without one, the rows of all versions of the table have the widest type that a column ever had.
        """
        if schema is None:
            frames = [self.spark.read.option("mergeSchema", "true").parquet(p) for p in self.versions(table)]
            kinds = _widest(frames)
            merged = [f.select(*[F.col(c).cast(kinds[c]).alias(c) for c in f.columns]) for f in frames]
            return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), merged)
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def versions(self, table: str) -> list[str]:
        """The folders of a table: its own, and one for each time that a column got a wider type."""
        marks = [n.split(VERSION) for n in folders_in(self.spark, f"{self.root.rstrip('/')}/{self.name}")]
        later = sorted(int(m[1]) for m in marks if len(m) == 2 and m[0] == table and m[1].isdigit())
        return [self.path(table), *[f"{self.path(table)}{VERSION}{n}" for n in later]]

    def register(self, table: str) -> str:
        """Make a table known to the catalog, so that SQL can name it."""
        full = f"`{self.name}`.`{table}`"
        if len(self.versions(table)) > 1:
            raise ValueError(f"{full} has versions of several types; write it anew before it is registered")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.name}` LOCATION '{self.root}/{self.name}'")
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")
        self.spark.catalog.createTable(f"{self.name}.{table}", path=self.path(table), source="parquet")
        if any(c.isPartition for c in self.spark.catalog.listColumns(f"{self.name}.{table}")):
            self.spark.catalog.recoverPartitions(f"{self.name}.{table}")
        return full

    def resolve(self, table: str, fallback: "Lakehouse | None" = None) -> DataFrame:
        """The catalog's table if there is one, else this root's, else the fallback's."""
        if self.spark.catalog.tableExists(f"{self.name}.{table}"):
            return self.spark.table(f"{self.name}.{table}")
        if fallback is not None and not self.exists(table):
            return fallback.read(table)
        return self.read(table)

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """Append, adding new columns and leaving absent ones NULL; nothing to add is no change.

        Columns are matched by name. A column of a wider type (whole numbers, longer ones, decimals, text) is
        widened: such rows go to a new version of the table, nothing is rewritten, and reading gives all rows
        the wider type. A narrower one becomes the known type. A value that fits neither ends the job: nothing
        is stored as NULL that was not.
        """
        df = df.select(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.NullType)])
        if df.isEmpty():
            return
        path = self.path(table)
        if self.exists(table):
            known = {f.name: f.dataType for f in self.read(table).schema}
            kinds = {c: wider(known[c], df.schema[c].dataType) for c in df.columns if c in known}
            df = df.select(*[fitting(F.col(c), kinds[c], c).alias(c) if c in kinds else F.col(c) for c in df.columns])
            versions = self.versions(table)
            path = versions[-1]
            last = {f.name: f.dataType for f in self.spark.read.option("mergeSchema", "true").parquet(path).schema}
            if any(last.get(c, k) != k for c, k in kinds.items()):
                path = f"{self.path(table)}{VERSION}{len(versions)}"
        if partition_by:
            df = df.hint("rebalance", *partition_by)  # few files per partition, busy ones split
        writer = df.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)

    def replace_batch(self, table: str, df: DataFrame, batch_id: int, day_of: str, run: str) -> None:
        """Write one micro-batch of a run under its own partitions; a replay replaces itself.

        Batches are numbered from 0 in each checkpoint, so run names the one they belong to.
        """
        keys = {"day": F.to_date(day_of), "run": F.lit(run), "batch_id": F.lit(int(batch_id)).cast("long")}
        keyed = df.withColumns(keys)
        (
            keyed.hint("rebalance", "day")  # few files per day, and a busy day is split
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "run", "batch_id")
            .parquet(self.path(table))
        )

    def replace_days(self, table: str, df: DataFrame, days: list[date], run: str) -> None:
        """Write a batch run's rows of some days, which have a column ``day``; running them again replaces them.

        Tables that streams write too have the same partitions, so both can share one.
        """
        for d in days:  # a day without rows now must not keep those of an earlier run
            delete_folder(self.spark, f"{self.path(table)}/day={d.isoformat()}/run={run}")
        keyed = df.withColumns({"run": F.lit(run), "batch_id": F.lit(0).cast("long")})
        keyed.hint("rebalance", "day").write.mode("append").partitionBy("day", "run", "batch_id").parquet(self.path(table))

    def drop_day_partitions(self, table: str, days: list[date]) -> None:
        for d in days:
            for path in self.versions(table):
                delete_folder(self.spark, f"{path}/day={d.isoformat()}")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the runs of one checkpoint, kept beside it."""
    path = f"{checkpoint.rstrip('/')}/run-id"
    try:
        known = spark.read.text(path).first()
    except AnalysisException:
        known = None
    if known is None:  # never written, or not to its end
        spark.createDataFrame([(uuid.uuid4().hex[:12],)], "value string").coalesce(1).write.mode("overwrite").text(path)
        known = spark.read.text(path).first()
    return known["value"]


def bounded_run(source: str) -> str:
    """The name of a bounded run over one source, the same each time."""
    return f"bounded-{uuid.uuid5(uuid.NAMESPACE_URL, source).hex[:12]}"


#: Between a table's name and the number of a later version.
VERSION = "__v"
#: Types of whole numbers and decimals, each wider than those before it. Fixed values.
NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]


def wider(known: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both; the known one where the lattice has none."""
    if known == new:
        return known
    known, new = (T.DoubleType() if isinstance(k, T.FloatType) else k for k in (known, new))
    if known in NUMBERS and new in NUMBERS:
        return max(known, new, key=NUMBERS.index)
    simple = [*NUMBERS, T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()]
    if T.StringType() in (known, new) and known in simple and new in simple:
        return T.StringType()
    if {type(known), type(new)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return known


def _widest(frames: list[DataFrame]) -> dict[str, T.DataType]:
    kinds: dict[str, T.DataType] = {}
    for f in (f for frame in frames for f in frame.schema):
        kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return kinds


def fitting(value: Column, kind: T.DataType, name: str) -> Column:
    """The value as another type; one that is not NULL and would be becomes an error."""
    cast = value.try_cast(kind)
    problem = F.concat(F.lit(f"column {name} does not fit {kind.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(problem).cast(kind)).otherwise(cast)


# --- run metadata and ledger -------------------------------------------------------------------


def metadata_rows(spark: SparkSession, meta: dict) -> DataFrame:
    """Run settings as (k, JSON text) rows."""
    rows = [(k, json.dumps(v, default=str)) for k, v in meta.items()]
    return spark.createDataFrame(rows, "k string, v string")


def ledger_rows(days: DataFrame, scored: DataFrame, hits: DataFrame, stage: str) -> DataFrame:
    """For each of the days: how many rows were scored and how many flagged, none too."""
    size = F.count(F.lit(1))
    found = hits.groupBy("day").agg(size.alias("found"))
    return (
        days.join(scored.groupBy("day").agg(size.alias("scored")), "day", "left")
        .join(found, "day", "left")
        .select(
            "day",
            F.lit(stage).alias("stage"),
            F.coalesce("scored", F.lit(0).cast("long")).alias("rows_scored"),
            F.coalesce("found", F.lit(0).cast("long")).alias("rows_anoms"),
            F.current_timestamp().alias("inserted_at"),
        )
    )


def pending_days(days: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """Days without a ledger row for the stage."""
    done = ledger.where(F.col("stage") == stage).select("day")
    return days.join(done, "day", "left_anti")


def waiting_writers(active: DataFrame, complete: DataFrame) -> DataFrame:
    """(day, writer) pairs that landed rows but have not marked the day complete."""
    return active.select("day", "writer").distinct().join(complete.select("day", "writer"), ["day", "writer"], "left_anti")


# --- retention ---------------------------------------------------------------------------------


def retention_cutoff(table: DataFrame, keep_days: int) -> DataFrame:
    """First day that stays when only the latest ``keep_days`` present days are kept (else no row)."""
    days = table.select("day").distinct()
    newest = F.slice(F.reverse(F.array_sort(F.collect_set("day"))), 1, keep_days)
    kept = days.agg(newest.alias("kept"), F.count(F.lit(1)).alias("present"))
    return kept.where(F.col("present") > keep_days).select(F.element_at("kept", -1).alias("cutoff"))


def archive_before(lake: Lakehouse, table: str, cutoff: date, archive_root: str) -> int:
    """Copy older days to compressed Parquet, then drop them; the number of rows moved.

    The copy is complete before anything is dropped, and has the table's own partitions, which it replaces:
    a run that ended in between is repeated without a loss or a second copy.
    """
    old = lake.read(table).where(F.col("day") < F.lit(cutoff))
    per_day = old.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per old day
    if not per_day:
        return 0
    (
        old.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*[c for c in ("day", "run", "batch_id") if c in old.columns])
        .parquet(f"{archive_root.rstrip('/')}/{table}")
    )
    lake.drop_day_partitions(table, [r["day"] for r in per_day])
    return sum(r["n"] for r in per_day)


def enforce_retention(lake: Lakehouse, table: str, keep_days: int, archive_root: str) -> int:
    row = retention_cutoff(lake.read(table), keep_days).first()
    return archive_before(lake, table, row["cutoff"], archive_root) if row else 0


MINUTE_STATS_TABLE = "minute_stats"
ANOMALIES_TABLE = "anomalies"


def write_stats(lake: Lakehouse, stats: DataFrame, run: str = "bounded") -> None:
    """Fixed column order of the statistics table; a run that is repeated replaces itself."""
    rows = stats.select(*[F.col(f.name).cast(f.dataType) for f in S.MINUTE_STATS])
    lake.replace_batch(MINUTE_STATS_TABLE, rows, 0, "window_start", run)


def write_anomalies(lake: Lakehouse, hits: DataFrame, run: str = "bounded") -> None:
    rows = hits.select(*[F.col(f.name).cast(f.dataType) for f in S.ANOMALIES])
    lake.replace_batch(ANOMALIES_TABLE, rows, 0, "window_start", run)
