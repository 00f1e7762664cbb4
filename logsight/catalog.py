"""Every implemented query by name, over the query log derived from a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.functions import values as V
from logsight.functions.classify import Measures, query_class
from logsight.operators import anomaly, features, ranks, sampling, windows
from logsight.operators.anomaly import AnomalyThresholds
from logsight.plans import backtest, models, regimes, report, retrain
from logsight.scratch import materialise, scratch_path
from logsight.session import use_utc
from logsight.sources import arrow_shards, files, ingest, kafka, registry, store
from logsight.sources.query_log import fixture_predictions, query_log, query_log_from_events
from logsight.streaming import landing, scoring
from logsight.streaming import stats as stream_stats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHECK_DAY = date(2024, 1, 10)
RELAXED = {
    "flags_high_ratio": AnomalyThresholds(underestimate_ratio=1000.0),
    "flags_rank_only": AnomalyThresholds(underestimate_ratio=1e9, underestimate_delta_ms=1e12),
    "flags_ratio_and_rank": AnomalyThresholds(underestimate_delta_ms=1e12),
}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _new_lake(spark: SparkSession, name: str) -> store.Lakehouse:
    return store.Lakehouse(spark, scratch_path(spark, "lake"), name)


# --- sources and typing ------------------------------------------------------------------------


@query
def log_scan(spark, sf):
    """A-01: event log scan."""
    return files.scan_log(spark, f"{sf}/events.parquet")


@query
def first_messages(spark, sf):
    """G-08: the first thousand events by arrival."""
    return query_log(spark, sf).select("arrival_timestamp", "query_id").orderBy("arrival_timestamp", "query_id").limit(1000)


@query
def query_log_view(spark, sf):
    return query_log(spark, sf)


@query
def day_scan(spark, sf):
    """A-02: one day by a pushed-down half-open range, projected."""
    return files.read_day(spark, f"{sf}/events.parquet", CHECK_DAY, ["event_id", "ts", "user_id", "absent"], ts="ts")


@query
def present_columns(spark, sf):
    """A-08: wanted columns that exist."""
    return files.keep_present(query_log(spark, sf), ["query_id", "no_such_column", "query_type", "user_id"])


@query
def log_days(spark, sf):
    """A-05: distinct days."""
    return files.distinct_days(query_log(spark, sf))


@query
def days_in_bounds(spark, sf):
    """B-13: inclusive day bounds."""
    return files.between_days(files.distinct_days(query_log(spark, sf)), date(2024, 1, 5), date(2024, 1, 20))


@query
def training_windows(spark, sf):
    """F-07: the seven present days before each day."""
    return files.training_windows(files.distinct_days(query_log(spark, sf)), 7)


@query
def latest_days(spark, sf):
    """F-08: the newest fourteen days."""
    return files.latest_days(files.distinct_days(query_log(spark, sf)), 14)


@query
def daily_file_scan(spark, sf):
    """A-03, A-04: dated files found by name, then read and counted."""
    log = query_log(spark, sf).select("query_id", "arrival_timestamp")
    root = scratch_path(spark, "daily")
    named = log.withColumn("queries", F.concat(F.date_format(S.TIME, "yyyy-MM-dd"), F.lit(".parquet")))
    named.write.partitionBy("queries").parquet(root)
    listed = files.daily_files(spark, root)
    paths = [r["path"] for r in listed.collect()]  # one row per daily file
    scanned = files.scan_training_files(spark, paths, ["query_id", "arrival_timestamp"])
    rows = scanned.groupBy(F.to_date(S.TIME).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return listed.select("day").distinct().join(rows, "day")


@query
def training_union(spark, sf):
    """A-10, H-02: frames with different columns put together by name."""
    log = query_log(spark, sf)
    early = log.where(F.col("arrival_timestamp") < F.lit("2024-01-16").cast("timestamp"))
    late = log.where(F.col("arrival_timestamp") >= F.lit("2024-01-16").cast("timestamp"))
    return early.select("query_id", "query_type").unionByName(
        late.select("query_type", "query_id", "num_joins"), allowMissingColumns=True
    )


def _messages(spark, sf) -> DataFrame:
    """The log as JSON messages, some cut short and some without a readable time."""
    log = query_log(spark, sf)
    text = F.col("value")
    sent = kafka.as_messages(log, key="instance_id").select(
        text, F.get_json_object(text, "$.query_id").cast("long").alias("q")
    )
    broken = (
        F.when(F.col("q") % 50 == 0, F.substring(text, 1, 20))
        .when(F.col("q") % 50 == 1, F.regexp_replace(text, '"arrival_timestamp":"[^"]*"', '"arrival_timestamp":"soon"'))
        .when(F.col("q") % 50 == 2, F.regexp_replace(text, '"arrival_timestamp":"[^"]*",', ""))
        .otherwise(text)
    )
    return sent.select(broken.alias("value"))


@query
def accepted_messages(spark, sf):
    """A-12, B-01, B-02, I-20: JSON events decoded and typed."""
    typed = ingest.accepted(ingest.decode_json(_messages(spark, sf)))
    return typed.withColumns({c: F.col(c).cast("long") for c in ("mbytes_scanned", "mbytes_spilled")})


@query
def rejected_messages(spark, sf):
    """B-01, B-02: what could not be read, by reason."""
    rejected = ingest.rejects(ingest.decode_json(_messages(spark, sf)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def anomaly_messages(spark, sf):
    """A-13: anomalies as keyed JSON messages with ISO times."""
    hits = _hits(spark, sf).select("query_id", "instance_id", "true_ms", "anomaly_reason", "arrival_timestamp")
    out = kafka.as_messages(hits)
    return out.select(
        "key",
        F.get_json_object("value", "$.query_id").cast("long").alias("query_id"),
        F.get_json_object("value", "$.anomaly_reason").alias("anomaly_reason"),
        F.get_json_object("value", "$.arrival_timestamp").alias("sent_at"),
    )


def _dirty(log: DataFrame) -> DataFrame:
    q = F.col("query_id")
    return log.select(
        q,
        F.when(q % 7 == 0, "x").when(q % 7 == 1, "").otherwise(F.col("num_joins").cast("string")).alias("num_joins"),
        F.when(q % 5 == 0, "not a time").otherwise(F.date_format(S.TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias(S.TIME),
        F.element_at(
            F.array(*[F.lit(w) for w in ("true", "False", "YES", "no", "1", " t ")]), (q % 6 + 1).cast("int")
        ).alias("was_cached"),
        F.when(q % 4 != 0, (q % 2).cast("int")).alias("was_aborted"),
        F.when(q % 3 == 0, "nan").when(q % 3 == 1, "12.5").otherwise("12").alias("mbytes_scanned"),
        F.when(q % 2 == 0, F.array(F.lit(1), F.lit(2), q)).alias("read_table_ids"),
    )


@query
def typed_events(spark, sf):
    """B-05, B-08, I-25: dirty text typed to the event schema."""
    return ingest.type_events(_dirty(query_log(spark, sf))).select(
        "query_id", "num_joins", S.TIME, "was_cached", "was_aborted", "mbytes_scanned", "read_table_ids", "user_id"
    )


@query
def bool_flags(spark, sf):
    """B-07: booleans from words, numbers and a missing column."""
    d = _dirty(query_log(spark, sf))
    return d.select(
        "query_id",
        *[V.to_bool(F.col(c), V.type_of(d, c)).alias(c) for c in S.BOOL_COLUMNS],
        V.to_bool(F.col("missing"), V.type_of(d, "missing")).alias("missing"),
    )


@query
def normalised_batch(spark, sf):
    """B-06, B-09, B-22: raw batch made uniform, absent columns added."""
    log = query_log(spark, sf).select("query_id", "query_type", "feature_fingerprint", S.TIME, "read_table_ids")
    out = V.add_missing(ingest.normalise_batch(log), ["cluster_size"], F.lit(None).cast("double"))
    return V.add_missing(out, ["fp_bucket"], F.lit(S.MISSING_CATEGORY))


@query
def landable_events(spark, sf):
    """B-03, A-14: what is landed per day: neither cached nor aborted."""
    kept = ingest.landable(query_log(spark, sf)).withColumn("day", F.to_date(S.TIME))
    landed = materialise(kept, "landed", partition_by=["day"])
    return landed.groupBy(F.col("day").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("execution_duration_ms").alias("exec_ms")
    )


@query
def id_lists(spark, sf):
    """I-05, I-07, I-08: table id lists between text and arrays."""
    log = query_log(spark, sf)
    text = F.col("read_table_ids")
    as_list = F.when(text.isNotNull(), F.split(text, ","))
    ids = log.select("query_id", text, as_list.alias("ids"), F.col("database_id"))
    one = V.to_id_list(F.col("database_id"), T.LongType())
    return ids.select(
        "query_id",
        V.csv_count(text).cast("long").alias("n_ids"),
        V.ids_to_csv(F.col("ids"), V.type_of(ids, "ids")).alias("csv"),
        F.size(V.to_id_list(F.col("ids"), V.type_of(ids, "ids"))).cast("long").alias("n_listed"),
        F.array_join(one, ",").alias("database_csv"),
    )


@query
def time_values(spark, sf):
    """I-01, I-02, I-03: ISO text to timestamp and on."""
    log = query_log(spark, sf)
    iso = F.date_format(S.TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    ts = V.to_timestamp(iso, T.StringType())
    return log.select(
        "query_id",
        ts.alias("parsed"),
        V.epoch_ms(ts).alias("epoch_ms"),
        V.hour_floor(ts).alias("hour"),
        F.to_date(ts).alias("day"),
    )


@query
def file_days(spark, sf):
    """I-19: days out of file names."""
    log = query_log(spark, sf)
    name = F.when(F.col("query_id") % 3 == 0, F.concat(F.lit("shard_"), F.col("query_id").cast("string"))).otherwise(
        F.concat(F.lit("queries_"), F.date_format(S.TIME, "yyyy-MM-dd"), F.lit("_shard.parquet"))
    )
    return log.select("query_id", V.day_from_name(name).alias("day"))


@query
def finite_values(spark, sf):
    """B-21: NaN and infinities become NULL in a report."""
    q = F.col("query_id")
    x = (
        F.when(q % 5 == 0, F.lit(float("nan")))
        .when(q % 5 == 1, F.lit(float("inf")))
        .when(q % 5 == 2, F.lit(float("-inf")))
        .otherwise(q.cast("double"))
    )
    return V.finite_report(query_log(spark, sf).select("query_id", x.alias("x")))


@query
def flattened_records(spark, sf):
    """B-18: lists of records flattened, NULL records skipped."""
    def rec(kind: str, col: str):
        body = F.struct("query_id", F.lit(kind).alias("kind"), F.col(col).alias("ms"))
        return F.when(F.col(col).isNotNull(), body)

    log = query_log(spark, sf)
    parts = F.array(rec("compile", "compile_duration_ms"), rec("execute", "execution_duration_ms"))
    return windows.flatten_batches(log.select(parts.alias("records")), "records")


# --- classes and windows -----------------------------------------------------------------------


@query
def classified_queries(spark, sf):
    """C-01 to C-08: class of every query."""
    return query_log(spark, sf).select("query_id", query_class().alias("query_class"))


@query
def classified_strict(spark, sf):
    """C-09: case-sensitive form where NULLs propagate."""
    return query_log(spark, sf).select("query_id", query_class(strict=True).alias("query_class"))


@query
def class_measures(spark, sf):
    """C-04, C-07: execution per scanned MB and complexity."""
    m = Measures()
    return query_log(spark, sf).select(
        "query_id", m.scan_ratio.alias("scan_ratio"), m.complexity.alias("complexity")
    )


@query
def minute_stats(spark, sf):
    """E-01, E-02, J-03: ten-minute windows."""
    return windows.minute_stats(query_log(spark, sf))


@query
def hour_stats(spark, sf):
    return windows.minute_stats(query_log(spark, sf), "1 hour")


@query
def day_stats(spark, sf):
    return windows.minute_stats(query_log(spark, sf), "1 day")


@query
def filled_cluster_size(spark, sf):
    """F-06: last known cluster size of every event's instance."""
    return windows.fill_cluster_size(query_log(spark, sf)).select("query_id", "cluster_size")


# --- features ----------------------------------------------------------------------------------


@query
def fingerprint_counts(spark, sf):
    """E-04"""
    return features.fingerprint_counts(query_log(spark, sf))


@query
def fingerprint_features(spark, sf):
    """D-01, I-10: the first day counts, the whole month is looked up."""
    log = query_log(spark, sf)
    early = log.where(F.col(S.TIME) < F.lit("2024-01-02").cast("timestamp"))
    counts = materialise(features.fingerprint_counts(early), "fingerprints")
    out = features.with_fingerprint_features(log, counts)
    return out.select("query_id", "fp_freq", F.col("fp_is_rare").cast("long").alias("fp_is_rare"), "fp_bucket")


@query
def time_features(spark, sf):
    """I-04"""
    return features.with_time_features(query_log(spark, sf)).select("query_id", "arrival_hour", "arrival_dow")


@query
def table_counts(spark, sf):
    """I-05, I-06"""
    out = features.with_table_counts(query_log(spark, sf))
    return out.select("query_id", *[F.col(c).cast("long").alias(c) for c in ("read_table_count", "write_table_count", "has_write")])


def _prepared(spark, sf) -> DataFrame:
    log = query_log(spark, sf)
    return features.prepare(log, materialise(features.fingerprint_counts(log), "fingerprints"))


@query
def prepared_features(spark, sf):
    """K-01, K-02, B-04, B-08, B-11, I-09: model inputs."""
    spec = features.feature_spec()
    cols = [F.col(c).cast("double").alias(c) for c in spec.numeric]
    return _prepared(spark, sf).select("query_id", *spec.categorical, *cols, spec.target)


@query
def scaled_targets(spark, sf):
    """I-11, I-12, I-13, I-17, I-18, E-17: target scales and labels."""
    log = query_log(spark, sf)
    edges = models.quartile_edges(log)
    y = F.col(S.TARGET)
    q25, q50, q75 = (edges.select(c).scalar() for c in ("q25", "q50", "q75"))
    return log.select(
        "query_id",
        models.quartile_label(y, q25, q50, q75).cast("long").alias("quartile"),
        models.explode_label(y, 600_000.0).cast("long").alias("explodes"),
        F.round(V.log_target(y), 6).alias("log_ms"),
        F.round(V.from_log(V.log_target(y) - 1.0), 3).alias("back_ms"),
        F.greatest(y.cast("double"), F.lit(70000.0)).alias("conservative_ms"),
    )


@query
def target_quartiles(spark, sf):
    """E-17: exact quartile edges."""
    return models.quartile_edges(query_log(spark, sf))


@query
def training_profile(spark, sf):
    """E-20"""
    return report.training_profile(query_log(spark, sf))


# --- ranks, flags, summaries -------------------------------------------------------------------


def _flagged(spark, sf, t: AnomalyThresholds = AnomalyThresholds()) -> DataFrame:
    return anomaly.flag(fixture_predictions(query_log(spark, sf)), t=t)


def _hits(spark, sf) -> DataFrame:
    return anomaly.anomalies(fixture_predictions(query_log(spark, sf)))


@query
def instance_ranks(spark, sf):
    """F-01 to F-05"""
    log = fixture_predictions(query_log(spark, sf))
    return ranks.with_instance_ranks(log, S.TARGET, "pred_execution_ms").select("query_id", *ranks.RANK_COLUMNS)


FLAG_COLUMNS = ("query_id", "true_ms", "pred_ms_used", "abs_err_ms", "signed_err_ms", "under_ratio", "is_anomaly", "anomaly_reason")


@query
def flags_default(spark, sf):
    """I-14 to I-16"""
    return _flagged(spark, sf).select(*FLAG_COLUMNS)


def _register_flag_variants() -> None:
    for name, t in RELAXED.items():

        def run(spark: SparkSession, sf: str, t: AnomalyThresholds = t) -> DataFrame:
            log = fixture_predictions(query_log(use_utc(spark), sf))
            return anomaly.anomalies(log, t=t).select(*FLAG_COLUMNS)

        QUERIES[name] = run


_register_flag_variants()


@query
def anomaly_hits(spark, sf):
    """B-19, B-20, E-03: hit records stamped with their window."""
    return windows.stamp_window(anomaly.hits(_hits(spark, sf)))


@query
def instance_summary(spark, sf):
    """E-05, G-03"""
    return anomaly.anomaly_summary(materialise(_hits(spark, sf), "hits"), "instance_id")


@query
def user_summary(spark, sf):
    """E-05"""
    return anomaly.anomaly_summary(materialise(_hits(spark, sf), "hits"), "user_id")


@query
def row_sample(spark, sf):
    """G-05: exact-size sample of the log."""
    return sampling.sample_rows(query_log(spark, sf), 500).select("query_id", "instance_id", "query_type")


@query
def control_sample(spark, sf):
    """G-06: exact-size sample of the rows that were not flagged."""
    rest = materialise(_flagged(spark, sf), "flagged").where(~F.col("is_anomaly"))
    return sampling.sample_rows(rest, 200, seed=1).select("query_id", "true_ms", "under_ratio")


@query
def daily_control_sample(spark, sf):
    """G-06, K-12: exact-size sample of the unflagged rows of every day."""
    rest = materialise(_flagged(spark, sf), "flagged").where(~F.col("is_anomaly"))
    daily = rest.select("query_id", F.to_date(S.TIME).alias("day"), "true_ms")
    return sampling.sample_per_group(daily, 15, ["day"], seed=2)


@query
def daily_instance_ranks(spark, sf):
    """F-01 to F-04 within each day and instance, as a backtest takes them."""
    log = fixture_predictions(query_log(spark, sf)).withColumn("day", F.to_date(S.TIME))
    return ranks.with_instance_ranks(log, S.TARGET, "pred_execution_ms", backtest.RANKED_BY).select(
        "query_id", *ranks.RANK_COLUMNS
    )


@query
def daily_user_summary(spark, sf):
    """E-05 per day, as a backtest writes it."""
    hits = materialise(_hits(spark, sf).withColumn("day", F.to_date(S.TIME)), "hits")
    return anomaly.anomaly_summary(hits, "user_id", ["day"])


# --- reports -----------------------------------------------------------------------------------


def _tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    log = materialise(query_log(spark, sf), "log")
    stats = materialise(windows.minute_stats(log), "stats")
    hits = anomaly.anomalies(fixture_predictions(log))
    return stats, materialise(windows.stamp_window(anomaly.hits(hits)), "hits")


def _stats(spark, sf) -> DataFrame:
    return materialise(windows.minute_stats(query_log(spark, sf)), "stats")


REPORT_IDS = [1, 2, 3, 5, 8]


@query
def report_bounds_day(spark, sf):
    """E-14, G-02"""
    return report.time_window_table(windows.minute_stats(query_log(spark, sf)), "24h")


@query
def report_bounds_week(spark, sf):
    return report.time_window_table(windows.minute_stats(query_log(spark, sf)), "1week")


@query
def report_instances(spark, sf):
    """E-11, B-14"""
    stats = _stats(spark, sf)
    return report.instance_ids(stats, report.time_window(stats, "24h"))


@query
def critical_instances(spark, sf):
    """E-12, G-04"""
    stats = _stats(spark, sf)
    return report.critical_instances(stats, report.time_window(stats, "1week"))


@query
def critical_problem_types(spark, sf):
    """E-13, B-15, D-06"""
    stats = _stats(spark, sf)
    return report.critical_problem_types(stats, report.time_window(stats, "24h"), REPORT_IDS)


@query
def critical_problem_types_by_union(spark, sf):
    """H-01"""
    stats = _stats(spark, sf)
    return report.critical_problem_types_by_union(stats, report.time_window(stats, "24h"), REPORT_IDS)


@query
def fleet_metrics(spark, sf):
    """E-06, E-07, E-08, D-03"""
    stats, hits = _tables(spark, sf)
    return report.fleet_metrics(stats, hits, report.time_window(stats, "1week"), REPORT_IDS)


@query
def anomaly_details(spark, sf):
    """B-16"""
    stats, hits = _tables(spark, sf)
    return report.anomaly_details(hits, report.time_window(stats, "1week"), REPORT_IDS)


@query
def class_chart(spark, sf):
    """E-09, G-01"""
    stats = _stats(spark, sf)
    return report.class_chart(stats, report.time_window(stats, "24h"), REPORT_IDS)


@query
def class_shares(spark, sf):
    """E-18"""
    stats = _stats(spark, sf)
    return report.class_shares(report.class_chart(stats, report.time_window(stats, "24h"), REPORT_IDS))


@query
def class_totals(spark, sf):
    """E-10, D-02, I-21"""
    stats, hits = _tables(spark, sf)
    return report.class_totals(stats, hits, report.time_window(stats, "1week"), REPORT_IDS)


@query
def class_totals_rows(spark, sf):
    """E-19"""
    stats, hits = _tables(spark, sf)
    return report.totals_as_rows(report.class_totals(stats, hits, report.time_window(stats, "1week"), REPORT_IDS))


# --- tables, ledger, retention -----------------------------------------------------------------


@query
def evolved_table(spark, sf):
    """A-20: appends with a new column, an absent column and another order."""
    lake = _new_lake(spark, "evolve")
    log = query_log(spark, sf)
    half = F.col("query_id") % 2
    lake.append("t", log.where(half == 0).select("query_id", "query_type", "num_joins"))
    lake.append("t", log.where(F.lit(False)).select("query_id"))
    lake.append("t", log.where(half == 1).select("num_scans", F.col("query_id").cast("int").alias("query_id"), "query_type"))
    return lake.read("t").select("query_id", "query_type", "num_joins", "num_scans")


@query
def widened_table(spark, sf):
    """A-20: a column that outgrows its type: whole numbers, then longer ones, decimals and text."""
    lake = _new_lake(spark, "widen")
    log = query_log(spark, sf)
    number = F.col("query_id").cast("int")
    pieces = [number, F.col("query_id") + (1 << 40), F.col("query_id") / 2, F.concat(F.lit("q"), F.col("query_id"))]
    for i, piece in enumerate([*pieces, number]):
        rows = log.where(F.col("query_id") % 5 == i)
        lake.append("t", rows.select("query_id", piece.alias("word"), (piece if i < 2 else number).alias("number")))
    return lake.read("t")


@query
def shard_scan(spark, sf):
    """A-07, K-10: Arrow shards on shared storage, some columns of them, types made to fit."""
    lake = _new_lake(spark, "shards")
    log = query_log(spark, sf).withColumn("num_scans", F.col("num_scans").cast("int"))
    folder = lake.path("shards")
    uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    paths = arrow_shards.write_shards(log.repartition(3, "query_id"), uri)
    named = [r["path"] for r in paths.collect()]  # one row a shard
    wanted = ["query_id", "query_type", "num_scans", "execution_duration_ms"]
    return files.scan_training_files(spark, named, wanted, S.QUERY_EVENT)


@query
def manifest_scan(spark, sf):
    """A-08, A-11, K-10: training rows from the files that a list names."""
    lake = _new_lake(spark, "manifest")
    log = query_log(spark, sf)
    half = F.col("query_id") % 2
    log.where(half == 0).select("query_id", "query_type").write.parquet(lake.path("a.parquet"))
    log.where(half == 1).select("query_type", "query_id", "num_joins").write.orc(lake.path("b.orc"))
    lines = [lake.path("a.parquet"), "", f"  {lake.path('b.orc')} ", lake.path("a.parquet")]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(lake.path("list"))
    paths = [r["path"] for r in files.read_manifest(spark, lake.path("list")).collect()]  # one row a file
    return files.scan_training_files(spark, paths, ["query_id", "query_type", "num_joins"])


@query
def trained_days(spark, sf):
    """J-10, J-11, D-05, J-14: landed by a stream, each seventh day that is complete gets one model."""
    lake = _new_lake(spark, "rollover")
    path, checkpoint = lake.path("events"), lake.path("checkpoint")
    landing.start_landing(
        _event_stream(spark, sf), path, checkpoint, {"availableNow": True}, lake=lake, writer="w0"
    ).awaitTermination()
    config = models.ModelConfig(max_iter=1, train_window_days=7, min_train_rows=1)
    for _ in range(2):  # the second run finds nothing due
        retrain.train_due(lake, spark.read.parquet(path), config, every=7)
    return lake.read(registry.REGISTRY).groupBy("trained_on", "stage").agg(F.count_if(~F.col("retired")).alias("versions"))


@query
def stopped_stream(spark, sf):
    """J-12: a stream that ends with its third day; rows of later days in the same batch are not counted."""
    lake = _new_lake(spark, "stopped")
    run = stream_stats.start_stats(
        _event_stream(spark, sf), lake, lake.path("checkpoint"), {"processingTime": "0 seconds"}, width="1 hour", max_days=3
    )
    run.awaitTermination()
    closed = stream_stats.read_stats(lake).select(*S.MINUTE_STATS.names)
    rows = closed.unionByName(stream_stats.open_windows(spark, lake.path("checkpoint")))
    return rows.groupBy(F.to_date("window_start").alias("day")).agg(F.sum("total_queries").alias("queries"))


@query
def stats_table(spark, sf):
    """A-15, A-16, A-18, A-19, B-17: statistics written, registered and read back by name."""
    lake = _new_lake(spark, "stream")
    store.write_stats(lake, windows.minute_stats(query_log(spark, sf), "1 hour"))
    lake.register(store.MINUTE_STATS_TABLE)
    return lake.resolve(store.MINUTE_STATS_TABLE).select(*S.MINUTE_STATS.names)


@query
def anomaly_table(spark, sf):
    """A-17: anomalies flattened to fixed columns, appended and read back."""
    lake = _new_lake(spark, "ml")
    store.write_anomalies(lake, windows.stamp_window(anomaly.hits(_hits(spark, sf))))
    return lake.read(store.ANOMALIES_TABLE).select("window_start", "query_id", "anomaly_reason", "true_ms", "pred_ms")


@query
def ledger(spark, sf):
    """E-15: rows scored and flagged per day."""
    flagged = materialise(_flagged(spark, sf).withColumn("day", F.to_date(S.TIME)), "flagged")
    days = flagged.select("day").distinct()
    return store.ledger_rows(days, flagged, flagged.where("is_anomaly"), S.STAGE).drop("inserted_at")


@query
def pending_days(spark, sf):
    """D-04: days without a ledger row; days with an even number are done."""
    days = files.distinct_days(query_log(spark, sf))
    done = days.where(F.dayofmonth("day") % 2 == 0).withColumn("stage", F.lit(S.STAGE))
    return store.pending_days(days, done, S.STAGE)


@query
def waiting_writers(spark, sf):
    """D-05, H-03, J-14: writers that landed rows of a day without having moved past it."""
    log = query_log(spark, sf)
    writer = F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string"))
    progress = log.groupBy(F.to_date(S.TIME).alias("seen_day"), writer.alias("writer")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(S.TIME).alias("latest")
    )
    return landing.incomplete(progress)


@query
def retention_cutoff(spark, sf):
    """J-13: first day kept when the latest eight present days stay."""
    return store.retention_cutoff(files.distinct_days(query_log(spark, sf)), 8)


@query
def archived_stats(spark, sf):
    """A-22, E-16: statistics left after retention, and how many went to the archive."""
    lake = _new_lake(spark, "retain")
    store.write_stats(lake, windows.minute_stats(query_log(spark, sf), "1 day"))
    moved = store.enforce_retention(lake, store.MINUTE_STATS_TABLE, 8, lake.path("archive"))
    kept = lake.read(store.MINUTE_STATS_TABLE)
    return kept.agg(
        F.count(F.lit(1)).alias("kept"), F.min("day").alias("first_day"), F.lit(moved).cast("long").alias("moved")
    )


# --- regimes -----------------------------------------------------------------------------------


@query
def ratio_profile(spark, sf):
    """M-01"""
    return regimes.ratio_profile(query_log(spark, sf))


@query
def scan_profile(spark, sf):
    """M-02"""
    return regimes.scan_profile(query_log(spark, sf))


@query
def transfer_profile(spark, sf):
    """M-03"""
    return regimes.transfer_profile(query_log(spark, sf))


@query
def queue_profile(spark, sf):
    """M-04"""
    return regimes.queue_profile(query_log(spark, sf))


@query
def transitions(spark, sf):
    """M-05"""
    return regimes.transitions(query_log(spark, sf))


@query
def class_distribution(spark, sf):
    """M-06"""
    return regimes.class_distribution(query_log(spark, sf))


@query
def class_purity(spark, sf):
    """M-07"""
    return regimes.class_purity(query_log(spark, sf))


@query
def class_overlap(spark, sf):
    """M-08"""
    return regimes.class_overlap(query_log(spark, sf))


@query
def sensitivity(spark, sf):
    """M-09"""
    return regimes.sensitivity(query_log(spark, sf))


@query
def cpu_variants(spark, sf):
    """M-10"""
    return regimes.cpu_variants(query_log(spark, sf))


@query
def ratio_ceiling(spark, sf):
    """M-11"""
    ceiling = regimes.ratio_ceiling(query_log(spark, sf))
    return ceiling.withColumn("ratio_ceiling", F.round("ratio_ceiling", 9))


# --- models ------------------------------------------------------------------------------------

@query
def model_scores(spark, sf):
    """K-03 to K-11: a model trained on the first three weeks scores the rest."""
    log = materialise(query_log(spark, sf), "log")
    split = F.lit("2024-01-22").cast("timestamp")
    fitted = models.train_on(log.where(F.col(S.TIME) < split), models.ModelConfig())
    later = log.where(F.col(S.TIME) >= split)
    if fitted is None:  # fewer usable rows than a model needs
        return later.select("query_id", F.lit(None).cast("double").alias("pred_execution_ms")).where(F.lit(False))
    return models.score(fitted, later).select("query_id", S.TARGET, "pred_mean_ms", "pred_q_ms", "pred_execution_ms")


@query
def model_hits(spark, sf):
    """K-11, A-23: a saved and reloaded model finds anomalies in a raw batch."""
    lake = _new_lake(spark, "ml")
    log = materialise(query_log(spark, sf), "log")
    fitted = models.train_on(log, models.ModelConfig())
    if fitted is None:
        return spark.createDataFrame([], S.ANOMALY_HIT)
    registry.register(lake, fitted, CHECK_DAY)
    _, loaded = registry.load_latest(lake, S.STAGE)
    return scoring.detect(loaded, log)


@query
def backtest_ledger(spark, sf):
    """K-12, K-13, K-15: every day scored by a model of the week before, retrained every fortnight."""
    lake = _new_lake(spark, "backtest")
    log = materialise(query_log(spark, sf), "log")
    config = backtest.BacktestConfig(
        model=models.ModelConfig(drop_cached_train=True, train_window_days=7),
        retrain_every_days=14,
        control_sample=10,
    )
    backtest.run_backtest(spark, log, lake, config)
    return lake.read(backtest.LEDGER, S.PROCESSED_DAYS).select("day", "stage", "rows_scored", "rows_anoms")


@query
def model_bounds(spark, sf):
    """K-08 to K-11: predictions are at least a millisecond, and the larger of mean and quantile."""
    log = materialise(query_log(spark, sf), "log")
    scored = models.score(models.train_on(log, models.ModelConfig(min_train_rows=1)), log)
    used = F.col("pred_execution_ms")
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(used < 1).alias("below_floor"),
        F.count_if(used != F.greatest("pred_mean_ms", "pred_q_ms")).alias("not_larger"),
    )


@query
def model_checks(spark, sf):
    """K-04, K-05, K-08 to K-11: on rows it has not seen, a reloaded model covers and beats constants.

    The share below the quantile may miss 0.9 by what chance allows; squared and pinball losses may not be
    over those of the constant mean and quantile by more than a twentieth.
    """
    lake = _new_lake(spark, "checks")
    log = materialise(query_log(spark, sf), "log")
    seen = F.pmod(F.xxhash64("query_id"), F.lit(5)) != 0
    config = models.ModelConfig(min_train_rows=1)
    fitted = models.train_on(log.where(seen), config)
    registry.register(lake, fitted, CHECK_DAY)
    _, loaded = registry.load_latest(lake, S.STAGE)
    y, q = V.log_target(F.col(S.TARGET)), config.quantile
    columns = ["query_id", S.TARGET, "pred_mean_ms", "pred_q_ms"]
    first = models.score(fitted, log).select(*columns)
    again = materialise(models.score(loaded, log).select(*columns), "scored")
    kept = log.where(seen & ~F.col("was_aborted")).agg(F.avg(y).alias("mean_y"), F.percentile(y, q).alias("q_y"))
    held = again.where(~seen).crossJoin(F.broadcast(kept))  # one row

    def pinball(p):
        return F.avg(F.when(y > p, (y - p) * q).otherwise((p - y) * (1 - q)))

    mean, high = F.log1p("pred_mean_ms"), F.log1p("pred_q_ms")
    share = F.avg((y <= high).cast("int"))
    return held.agg(
        (F.abs(share - q) <= 0.01 + 4 * F.sqrt(F.lit(q * (1 - q)) / F.count(F.lit(1)))).alias("covers"),
        (F.avg(F.pow(y - mean, 2)) <= 1.05 * F.avg(F.pow(y - F.col("mean_y"), 2))).alias("mean_fits"),
        (pinball(high) <= 1.05 * pinball(F.col("q_y"))).alias("quantile_fits"),
    ).withColumn("changed_by_reload", F.lit(first.exceptAll(again).count()))


@query
def backtest_coverage(spark, sf):
    """K-12, K-15, D-04: every day after the first two is in the ledger, with all its usable rows."""
    lake = _new_lake(spark, "coverage")
    log = materialise(query_log(spark, sf), "log")
    model = models.ModelConfig(drop_cached_train=True, train_window_days=7, min_train_rows=1)
    backtest.run_backtest(spark, log, lake, backtest.BacktestConfig(model=model, retrain_every_days=14))
    return lake.read(backtest.LEDGER, S.PROCESSED_DAYS).select("day", "stage", "rows_scored")


@query
def category_codes(spark, sf):
    """K-03, B-10: codes of the query types, in alphabetical order."""
    spec = features.feature_spec()
    prepared = features.prepare(query_log(spark, sf), None, spec)
    coded = models.encode(prepared, spec, models.fit_indexer(prepared, spec))
    place = spec.categorical.index("query_type")
    code = F.get(vector_to_array("features"), F.lit(place)).cast("long")
    return coded.select("query_id", "query_type", code.alias("code"))


# --- streams -----------------------------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    """The events table as a file stream."""
    fields = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(fields).option("pathGlobFilter", "events.parquet").parquet(sf)
    return query_log_from_events(raw)


@query
def streamed_hour_stats(spark, sf):
    """J-01 to J-05, J-08: closed one-hour windows of a stream, with remembered cluster sizes."""
    lake = _new_lake(spark, "stream")
    run = stream_stats.start_stats(
        _event_stream(spark, sf), lake, lake.path("checkpoint"), {"availableNow": True},
        width="1 hour", delay="0 seconds", idle="0 seconds",
    )
    run.awaitTermination()
    return stream_stats.read_stats(lake).drop("day")


@query
def streamed_lagging_events(spark, sf):
    """J-03, J-04, J-05: four batches with lagging instances; every event is counted, late or still open."""
    lake = _new_lake(spark, "lagging")
    log = query_log(spark, sf)
    batch = F.floor((F.dayofmonth(S.TIME) - 1) / 8)
    behind = F.col(S.INSTANCE).isin(3, 7) & (F.col("query_id") % 5 == 0)
    arriving = log.withColumn("batch", F.when(behind, F.least(batch + 1, F.lit(3))).otherwise(batch))
    for k in range(4):
        arriving.where(F.col("batch") == k).drop("batch").write.mode("append").parquet(lake.path("incoming"))
        source = spark.readStream.schema(log.schema).parquet(lake.path("incoming"))
        stream_stats.start_stats(source, lake, lake.path("checkpoint"), {"availableNow": True}).awaitTermination()
    columns = ["instance_id", "window_start"]
    closed = stream_stats.read_stats(lake).select(*columns, F.col("total_queries").alias("events"))
    left = stream_stats.open_windows(spark, lake.path("checkpoint")).select(*columns, F.col("total_queries").alias("events"))
    late = lake.read(stream_stats.LATE_TABLE, stream_stats.late_schema(log.schema)).groupBy(*columns).agg(F.count("*").alias("events"))
    named = [rows.withColumn("outcome", F.lit(name)) for name, rows in (("closed", closed), ("open", left), ("late", late))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def streamed_landing(spark, sf):
    """J-06, A-14: training events landed by day by a stream."""
    lake = _new_lake(spark, "landing")
    run = landing.start_landing(
        _event_stream(spark, sf), lake.path("events"), lake.path("checkpoint"), {"availableNow": True}
    )
    run.awaitTermination()
    landed = spark.read.parquet(lake.path("events"))
    return landed.groupBy(F.col("day").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("execution_duration_ms").alias("exec_ms")
    )


@query
def streamed_anomaly_windows(spark, sf):
    """J-16: a stream of anomalies stamped with their windows and appended."""
    lake = _new_lake(spark, "hits")
    lake.append("incoming", anomaly.hits(_hits(spark, sf)))
    incoming = spark.readStream.schema(S.ANOMALY_HIT).parquet(lake.path("incoming"))
    run = scoring.start_anomaly_windows(incoming, lake, lake.path("checkpoint"), {"availableNow": True})
    run.awaitTermination()
    return lake.read(store.ANOMALIES_TABLE).select("window_start", "query_id", "anomaly_reason", "true_ms", "pred_ms")


def queries() -> dict[str, Query]:
    return dict(QUERIES)
