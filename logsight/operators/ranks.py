"""Where a query stands within its instance, by actual and by predicted time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.operators.lookup import lookup
from logsight.operators.order_stats import rows_below, value_counts
from logsight.scratch import materialise

RANK_COLUMNS = ("true_quantile", "pred_quantile", "true_rank_desc", "pred_rank_desc", "rank_gap_desc")


def _groups(by: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(by))]


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows without an instance, or a frame without that column, form one group."""
    unknown = F.lit(S.UNKNOWN_INSTANCE)
    if S.INSTANCE in by and S.INSTANCE not in df.columns:
        df = df.withColumn(S.INSTANCE, unknown)
    keys = {
        g: F.coalesce(F.col(c), unknown) if c == S.INSTANCE else F.col(c) for g, c in zip(_groups(by), by)
    }
    return df.withColumns(keys)


def rank_table(df: DataFrame, measures: dict[str, Column], by: Sequence[str] = (S.INSTANCE,)) -> DataFrame:
    """Per (group, measure, value): rows with it, tie-averaged quantile and descending rank.

    The table has one row per distinct value. It is written once because every measure is looked
    up on its own, and so that its known size decides between broadcast and shuffle.
    """
    groups = _groups(by)
    table = rows_below(value_counts(_grouped(df, by), groups, measures), groups)
    ascending = F.col("below") + (F.col("n") + 1) / 2.0
    ranks = table.select(
        *groups,
        "measure",
        "v",
        "n",
        (ascending / F.col("group_n")).alias("quantile"),
        (F.col("group_n") + 1 - ascending).alias("rank_desc"),
    )
    return materialise(ranks, "ranks")


def instance_ranks(df: DataFrame, true_col: str, pred_col: str, by: Sequence[str] = (S.INSTANCE,)) -> DataFrame:
    """The rank table of actual and predicted time."""
    return rank_table(df, {"true": F.col(true_col), "pred": F.col(pred_col)}, by)


def look_up_ranks(
    rows: DataFrame,
    table: DataFrame,
    true_col: str,
    pred_col: str,
    by: Sequence[str] = (S.INSTANCE,),
    row_id: str = "query_id",
) -> DataFrame:
    """Add each row's ranks from the table; a missing value has none."""
    groups = _groups(by)
    rows = _grouped(rows, by)
    spread_by = [row_id] if row_id in rows.columns else [true_col, pred_col]
    for name, col in (("true", true_col), ("pred", pred_col)):
        side = table.where(F.col("measure") == name).select(
            *groups,
            F.col("v").alias("_v"),
            F.col("n").alias("_n"),
            F.col("quantile").alias(f"{name}_quantile"),
            F.col("rank_desc").alias(f"{name}_rank_desc"),
        )
        value = F.col(col).cast("double")
        rows = rows.withColumn("_v", F.when(~F.isnan(value), value))
        rows = lookup(rows, side, [*groups, "_v"], "_n", spread_by)
    return rows.drop(*groups, "_v").withColumn("rank_gap_desc", F.col("pred_rank_desc") - F.col("true_rank_desc"))


def with_instance_ranks(df: DataFrame, true_col: str, pred_col: str, by: Sequence[str] = (S.INSTANCE,)) -> DataFrame:
    """Add tie-averaged percentile ranks and descending ranks of actual and predicted time.

    Missing values have no rank and do not count.
    """
    return look_up_ranks(df, instance_ranks(df, true_col, pred_col, by), true_col, pred_col, by)
