"""Exact-size samples that do not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the draw that each count of rows looks at: 16**4 groups. After two counts the rows left at the
#: cut-off are one in 16**8.
PREFIX = 4
COUNTS = 2


def draw(id_cols: Sequence[str], seed: int) -> Column:
    """A uniform draw per row identity, the same in every run and engine."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *text))


def sample_rows(df: DataFrame, n: int, id_cols: Sequence[str] = ("query_id",), seed: int = 0) -> DataFrame:
    """The ``n`` rows with the smallest draws; all rows when there are no more than ``n``.

    ``id_cols`` identify a row (copies of one row share its draw and stay together). The cut-off
    draw comes from counts per draw prefix (at most 65,536 rows), twice, then from counts per draw of the
    cut-off prefix, so the rows themselves are only filtered and never sorted or gathered.
    """
    if n <= 0:
        return df
    drawn = df.withColumn("_draw", draw(id_cols, seed))
    cut = _cuts(drawn, n, []).agg(F.min("_cut")).scalar()
    return drawn.where(cut.isNull() | (F.col("_draw") <= cut)).drop("_draw")


def _cuts(drawn: DataFrame, n: int, by: list[str]) -> DataFrame:
    """(by, _cut) of the groups with n rows or more: the draw at which they are reached.

    Rows are counted by the first digits of their draws, then, where n is reached, by the next ones.
    """
    size = F.count(F.lit(1)).alias("c")
    left, before = drawn, F.lit(0)
    for k in range(COUNTS):
        p = f"_p{k}"
        left = left.withColumn(p, F.substring("_draw", 1 + k * PREFIX, PREFIX))
        keys = [*by, *[f"_p{i}" for i in range(k)], *(["_before"] if k else [])]
        upto = before + F.sum("c").over(Window.partitionBy(*keys).orderBy(p))
        counted = left.groupBy(*keys, p).agg(size).withColumn("_upto", upto)
        crossing = counted.where((F.col("_upto") >= n) & (F.col("_upto") - F.col("c") < n))
        at = crossing.select(*[c for c in keys if c != "_before"], p, (F.col("_upto") - F.col("c")).alias("_before"))
        # one row per group: small where groups are few
        left = left.drop("_before").join(at, [c for c in at.columns if c != "_before"])
        before = F.col("_before")
    last = [*by, *[f"_p{i}" for i in range(COUNTS)], "_before"]
    inside = before + F.sum("c").over(Window.partitionBy(*last).orderBy("_draw"))
    reached = left.groupBy(*last, "_draw").agg(size).withColumn("_upto", inside).where(F.col("_upto") >= n)
    return reached.groupBy(*by).agg(F.min("_draw").alias("_cut"))


def sample_per_group(
    df: DataFrame, n: int, by: Sequence[str], id_cols: Sequence[str] = ("query_id",), seed: int = 0
) -> DataFrame:
    """:func:`sample_rows` within each group of a few, such as the days of a run."""
    drawn = df.withColumn("_draw", draw(id_cols, seed))
    kept = drawn.join(_cuts(drawn, n, list(by)), list(by), "left")
    return kept.where(F.col("_cut").isNull() | (F.col("_draw") <= F.col("_cut"))).select(*df.columns)
