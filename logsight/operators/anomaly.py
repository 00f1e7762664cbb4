"""Long queries the model expected to be short."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.operators.order_stats import with_quantiles
from logsight.operators.ranks import instance_ranks, look_up_ranks


@dataclass(frozen=True)
class AnomalyThresholds:
    """Fixed values of the anomaly rules."""

    min_long_ms: float = 60_000.0
    underestimate_ratio: float = 10.0
    underestimate_delta_ms: float = 120_000.0
    true_quantile: float = 0.99
    pred_quantile: float = 0.90


def _ms(name: str) -> Column:
    """A duration as a double; missing and NaN count as zero."""
    value = F.col(name).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def with_errors(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """Add actual and predicted time and the error measures between them."""
    actual, predicted = F.col("true_ms"), F.col("pred_ms_used")
    return df.withColumns({"true_ms": _ms(true_col), "pred_ms_used": _ms(pred_col)}).withColumns(
        {
            "abs_err_ms": F.abs(actual - predicted),
            "signed_err_ms": predicted - actual,
            "under_ratio": actual / F.greatest(predicted, F.lit(1.0)),
        }
    )


def with_flags(df: DataFrame, t: AnomalyThresholds = AnomalyThresholds()) -> DataFrame:
    """Add ``is_anomaly`` and the first rule that explains it; needs errors and ranks."""
    actual, predicted = F.col("true_ms"), F.col("pred_ms_used")
    slow = actual >= t.min_long_ms
    by_ratio = slow & (F.col("under_ratio") >= t.underestimate_ratio)
    by_delta = slow & (actual - predicted >= t.underestimate_delta_ms)
    misranked = (F.col("true_quantile") >= t.true_quantile) & (F.col("pred_quantile") <= t.pred_quantile)
    by_rank = slow & F.coalesce(misranked, F.lit(False))
    return df.withColumns(
        {
            "is_anomaly": by_ratio | by_delta | by_rank,
            "anomaly_reason": F.when(by_ratio, "underestimated_ratio")
            .when(by_delta, "underestimated_delta")
            .when(by_rank, "misrank_quantiles")
            .otherwise(""),
        }
    )


def flag_rows(
    rows: DataFrame,
    ranks: DataFrame,
    true_col: str = S.TARGET,
    pred_col: str = "pred_execution_ms",
    t: AnomalyThresholds = AnomalyThresholds(),
    by: Sequence[str] = (S.INSTANCE,),
) -> DataFrame:
    """Ranks, errors and flags for some rows, given the rank table of all."""
    ranked = look_up_ranks(rows, ranks, true_col, pred_col, by)
    return with_flags(with_errors(ranked, true_col, pred_col), t)


def is_long(df: DataFrame, true_col: str, t: AnomalyThresholds) -> Column:
    """Only a long query can be flagged, whatever was predicted.

    A comparison in the column's own type (NaN sorts above every number), which a Parquet scan can
    filter by.
    """
    col = F.col(true_col)
    if isinstance(df.schema[true_col].dataType, T.IntegralType):
        return col >= F.lit(math.ceil(t.min_long_ms)).cast(df.schema[true_col].dataType)
    return (col >= t.min_long_ms) & ~F.isnan(col)


def flag(
    df: DataFrame,
    true_col: str = S.TARGET,
    pred_col: str = "pred_execution_ms",
    t: AnomalyThresholds = AnomalyThresholds(),
) -> DataFrame:
    """Ranks, errors and flags for every scored row."""
    return flag_rows(df, instance_ranks(df, true_col, pred_col), true_col, pred_col, t)


def anomalies(
    df: DataFrame,
    true_col: str = S.TARGET,
    pred_col: str = "pred_execution_ms",
    t: AnomalyThresholds = AnomalyThresholds(),
) -> DataFrame:
    """Only the flagged rows.

    Every row counts in the ranks, but only the long ones are looked up and shuffled.
    """
    ranks = instance_ranks(df, true_col, pred_col)
    return flag_rows(df.where(is_long(df, true_col, t)), ranks, true_col, pred_col, t).where("is_anomaly")


def hits(flagged: DataFrame) -> DataFrame:
    """The fixed hit record of each anomaly; absent numbers are 0, absent fields NULL."""

    def field(name: str, kind) -> Column:
        source = "pred_ms_used" if name == "pred_ms" else name
        if source not in flagged.columns:
            zero = name.endswith("_ms") or name == "under_ratio"
            return (F.lit(0.0) if zero else F.lit(None)).cast(kind)
        col = F.col(source).try_cast(kind)  # an id that is no number is NULL
        if name.endswith("_ms") or name == "under_ratio":
            return F.coalesce(col, F.lit(0.0))
        return F.coalesce(col, F.lit("")) if name == "anomaly_reason" else col

    return flagged.select(*[field(f.name, f.dataType).alias(f.name) for f in S.ANOMALY_HIT])


def anomaly_summary(flagged: DataFrame, key: str, per: Sequence[str] = ()) -> DataFrame:
    """Count, sums and exact medians of the anomalies per key, worst first; a NULL key is a group.

    With ``per`` every combination of those columns has its own summary.
    """
    keys = [*per, key]
    totals = flagged.groupBy(*keys).agg(
        F.count_if("is_anomaly").alias("anoms"),
        F.sum("true_ms").alias("true_sum_ms"),
        F.sum("abs_err_ms").alias("abs_err_sum_ms"),
    )
    medians = {"median_true_ms": F.col("true_ms"), "median_under_ratio": F.col("under_ratio")}
    return with_quantiles(totals, flagged, keys, medians).orderBy(
        *per, F.col("anoms").desc(), F.col("true_sum_ms").desc(), F.col(key)
    )
