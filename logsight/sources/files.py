"""Scans of event logs and daily files, and the day lists that drive batch runs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.functions import values as V
from logsight.sources.arrow_shards import SUFFIXES, scan_shards

SCAN_FORMATS = {".parquet": "parquet", ".orc": "orc", ".json": "json", **dict.fromkeys(SUFFIXES, "arrow")}


def scan_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    log = spark.read.parquet(path)
    return log.limit(limit) if limit else log


def keep_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order; none at all is an error."""
    present = [c for c in wanted if c in df.columns]
    if not present:
        raise ValueError(f"none of the columns {wanted} exist; found {df.columns}")
    return df.select(*present)


def between_times(df: DataFrame, first: date, last: date, ts: str = S.TIME) -> DataFrame:
    """Rows from the first day to the end of the last, compared in the column's own type.

    Comparing without casting the column keeps the half-open range a Parquet row-group filter.
    """
    dtype = df.schema[ts].dataType

    def midnight(d: date) -> Column:
        return F.lit(datetime.combine(d, datetime.min.time()).isoformat(sep=" ")).cast(dtype)

    return df.where((F.col(ts) >= midnight(first)) & (F.col(ts) < midnight(last + timedelta(days=1))))


def on_day(df: DataFrame, day: date, ts: str = S.TIME) -> DataFrame:
    return between_times(df, day, day, ts)


def read_day(spark: SparkSession, path: str, day: date, columns: list[str], ts: str = S.TIME) -> DataFrame:
    return keep_present(on_day(spark.read.parquet(path), day, ts), columns)


def read_daily_file(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return keep_present(spark.read.parquet(path), columns)


def _file(path: Column) -> Column:
    """The path of a daily file; a file written by Spark is a folder of parts."""
    return F.regexp_replace(path, r"/part-[^/]*$", "")


def day_of_path(path: Column) -> Column:
    """The day in the name of a daily file."""
    return V.day_from_name(F.regexp_extract(_file(path), r"([^/]+)$", 1))


def daily_files(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", undated: str = "drop"
) -> DataFrame:
    """One row per file with the day in its name; contents are not read.

    ``undated='mtime'`` falls back to the day the file was last changed.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime")
    )
    day = day_of_path(F.col("path"))
    if undated == "mtime":
        day = F.coalesce(day, F.to_date("modificationTime"))
    return (
        listing.select(day.alias("day"), _file(F.col("path")).alias("path"))
        .where(F.col("day").isNotNull())
        .distinct()
        .orderBy("day", "path")
    )


def distinct_days(df: DataFrame, ts: str = S.TIME) -> DataFrame:
    return df.select(F.to_date(F.col(ts)).alias("day")).where(F.col("day").isNotNull()).distinct().orderBy("day")


def between_days(days: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Days within optional bounds, both ends included."""
    if start is not None:
        days = days.where(F.col("day") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("day") <= F.lit(end))
    return days


def training_windows(days: DataFrame, window_days: int) -> DataFrame:
    """For every day, the up to N present days before it (one row per pair).

    The day list has one row per calendar day, so ordering it in one place is cheap.
    """
    ordered = days.select("day", F.row_number().over(Window.orderBy("day")).alias("i"))
    before = F.sequence(F.col("i") - window_days, F.col("i") - 1)
    wanted = ordered.select(F.col("day").alias("eval_day"), F.explode(before).alias("i"))
    return wanted.join(ordered.withColumnRenamed("day", "train_day"), "i").select("eval_day", "train_day")


def latest_days(days: DataFrame, n: int) -> DataFrame:
    """The N most recent days of a list with one or more rows per day."""
    rank = F.dense_rank().over(Window.orderBy(F.col("day").desc()))
    return days.select("day").distinct().withColumn("r", rank).where(F.col("r") <= n).select("day")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-empty lines of a path list, in order of first appearance."""
    lines = spark.read.text(path).select(
        F.trim("value").alias("path"), F.monotonically_increasing_id().alias("line")
    )
    return (
        lines.where(F.col("path") != "")
        .groupBy("path")
        .agg(F.min("line").alias("line"))
        .orderBy("line")
        .select("path")
    )


def parse_paths(text: str) -> list[str]:
    """Paths of a comma-separated list, trimmed, without repeats."""
    return list(dict.fromkeys(p.strip() for p in text.split(",") if p.strip()))


def scan_training_files(
    spark: SparkSession, paths: list[str], wanted: list[str], kinds: T.StructType | None = None
) -> DataFrame:
    """All files as one frame by column name; an unknown suffix is an error.

    Arrow shards are read as the types that ``kinds`` gives the wanted columns.
    """
    by_format: dict[str, list[str]] = {}
    for p in paths:
        suffix = p[p.rfind("."):].lower() if "." in p else ""
        if suffix not in SCAN_FORMATS:
            raise ValueError(f"unsupported training file type: {p}")
        by_format.setdefault(SCAN_FORMATS[suffix], []).append(p)
    if not by_format:
        raise ValueError("no training files are named")
    frames = []
    for fmt, group in by_format.items():
        if fmt == "arrow":
            known = kinds or S.QUERY_EVENT
            frames.append(scan_shards(spark, group, T.StructType([known[c] for c in wanted if c in known.names])))
            continue
        reader = spark.read.option("mergeSchema", "true") if fmt != "json" else spark.read
        frames.append(keep_present(reader.format(fmt).load(group), wanted))
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f, allowMissingColumns=True)
    return merged
