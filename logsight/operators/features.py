"""Model inputs of a query, known once it is compiled."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.functions import values as V
from logsight.operators.lookup import lookup


def indicator_names() -> list[str]:
    missing = []
    for c in S.NUMERIC_FEATURES:
        missing.append(f"{c}__is_missing")
        if c in S.ZERO_INDICATORS:
            missing.append(f"{c}__is_zero")
    return missing


@dataclass(frozen=True)
class FeatureSpec:
    stage: str = S.STAGE
    target: str = S.TARGET
    categorical: list[str] = field(default_factory=lambda: list(S.CATEGORICAL_FEATURES))
    numeric: list[str] = field(default_factory=lambda: list(S.NUMERIC_FEATURES) + indicator_names())


def feature_spec(stage: str = S.STAGE, target: str = S.TARGET) -> FeatureSpec:
    if stage != S.STAGE:
        raise ValueError(f"unknown stage {stage!r}; only {S.STAGE!r} is supported")
    return FeatureSpec(stage=stage, target=target)


def fingerprint_counts(df: DataFrame) -> DataFrame:
    """How often each plan fingerprint occurs; missing ones count as ``NA``."""
    fp = F.coalesce(F.col("feature_fingerprint").cast("string"), F.lit(S.MISSING_CATEGORY))
    return df.groupBy(fp.alias("feature_fingerprint")).agg(F.count(F.lit(1)).alias("fp_freq"))


def with_time_features(df: DataFrame) -> DataFrame:
    """Hour of day and day of week with Monday as 0; NULL when there is no event time."""
    if S.TIME not in df.columns:
        null = F.lit(None).cast("double")
        return df.withColumns({"arrival_hour": null, "arrival_dow": null})
    ts = V.to_timestamp(F.col(S.TIME), V.type_of(df, S.TIME))
    return df.withColumn(S.TIME, ts).withColumns(
        {
            "arrival_hour": F.hour(S.TIME).cast("double"),
            "arrival_dow": F.weekday(S.TIME).cast("double"),
        }
    )


def with_table_counts(df: DataFrame) -> DataFrame:
    """How many tables a query reads and writes, and whether it writes at all."""

    def count(name: str):
        dtype = V.type_of(df, name)
        return V.csv_count(V.ids_to_csv(F.col(name), dtype)) if dtype is not None else F.lit(0)

    return df.withColumns(
        {"read_table_count": count("read_table_ids"), "write_table_count": count("write_table_ids")}
    ).withColumn("has_write", (F.col("write_table_count") > 0).cast("int"))


def with_fingerprint_features(df: DataFrame, counts: DataFrame | None, rare_below: int = 3) -> DataFrame:
    """Frequency of the query's fingerprint in the training window, as number and bucket."""
    if "feature_fingerprint" not in df.columns:
        return df.withColumns({"fp_freq": F.lit(0), "fp_is_rare": F.lit(0), "fp_bucket": F.lit("unknown")})
    fp = F.coalesce(F.col("feature_fingerprint").cast("string"), F.lit(S.MISSING_CATEGORY))
    df = df.withColumn("feature_fingerprint", fp)
    if counts is None:
        df = df.withColumn("fp_freq", F.lit(0).cast("long"))
    else:
        table = counts.withColumn("_n", F.col("fp_freq"))
        spread_by = ["query_id"] if "query_id" in df.columns else [c for c in df.columns if c != "feature_fingerprint"]
        df = lookup(df, table, ["feature_fingerprint"], "_n", spread_by)
        df = df.withColumn("fp_freq", F.coalesce(F.col("fp_freq"), F.lit(0).cast("long")))
    n = F.col("fp_freq")
    return df.withColumns(
        {
            "fp_is_rare": (n < rare_below).cast("int"),
            "fp_bucket": F.when(n == 0, "unseen")
            .when(n < rare_below, "rare")
            .when(n < 50, "moderate")
            .otherwise("common"),
        }
    )


def with_indicators(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """0/1 columns marking missing and zero values of the numeric features."""
    flags = {}
    for name in spec.numeric:
        if name.endswith("__is_missing"):
            flags[name] = F.col(name.removesuffix("__is_missing")).isNull().cast("int")
        elif name.endswith("__is_zero"):
            flags[name] = F.coalesce(F.col(name.removesuffix("__is_zero")) == 0, F.lit(False)).cast("int")
    return df.withColumns(flags)


def drop_flagged(df: DataFrame, drop_cached: bool = False, drop_aborted: bool = True) -> DataFrame:
    """Boolean flags made uniform, then aborted and cached queries left out as asked."""
    df = df.withColumns({c: V.to_bool(F.col(c), V.type_of(df, c)) for c in S.BOOL_COLUMNS})
    if drop_aborted:
        df = df.where(~F.col("was_aborted"))
    return df.where(~F.col("was_cached")) if drop_cached else df


def prepare(
    df: DataFrame,
    counts: DataFrame | None,
    spec: FeatureSpec | None = None,
    rare_below: int = 3,
    drop_cached: bool = False,
    drop_aborted: bool = True,
) -> DataFrame:
    """Raw events to model inputs: all raw columns plus every feature of the spec.

    Rows without event time or target are dropped when there is a target; targets are at least 0.
    """
    spec = spec or feature_spec()
    df = drop_flagged(df, drop_cached, drop_aborted)
    df = with_table_counts(with_time_features(df))
    if spec.target in df.columns:
        target = V.to_number(F.col(spec.target))
        df = df.withColumn(spec.target, target).dropna(subset=[S.TIME, spec.target])
        df = df.withColumn(spec.target, F.greatest(F.col(spec.target), F.lit(0.0)))
    df = with_fingerprint_features(df, counts, rare_below)
    df = V.add_missing(df, list(S.NUMERIC_FEATURES), F.lit(None).cast("double"))
    df = V.add_missing(df, list(S.CATEGORICAL_FEATURES), F.lit(S.MISSING_CATEGORY))
    df = df.withColumns({c: V.to_number(F.col(c)) for c in S.NUMERIC_FEATURES})
    df = df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(S.MISSING_CATEGORY)) for c in S.CATEGORICAL_FEATURES}
    )
    return with_indicators(df, spec)
