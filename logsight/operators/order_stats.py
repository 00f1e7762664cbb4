"""Exact order statistics per group, without ever sorting a whole group in one task.

Values are spread over fixed logarithmic buckets, and only bucket totals are summed along the order of a group,
so one that holds most of the table is sorted by as many tasks as it has buckets.

Quantiles need few places of that order. They are selected by refinement: a first pass shuffles counts per
bucket only; of the buckets that hold a wanted place, those with many rows are split again by their range until
none is dense; a last pass sorts the distinct values of what is left. Ranks need every value: rows are reduced to
distinct values with counts, and those are sorted within their buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsight.scratch import materialise

#: Buckets per doubling of the value; one bucket spans about half a percent.
STEPS = 128
#: Larger than the lowest exponent of a double, so that buckets of positive values are positive.
SHIFT = 1100 * STEPS


def value_bucket(v: Column) -> Column:
    """Bucket number that never decreases as the value grows."""
    size = F.floor(F.log2(F.abs(v)) * STEPS) + SHIFT
    zero = F.lit(0).cast("long")
    # known not to be NULL, so that a join on it needs no filter and the shuffle below is reused
    return F.coalesce(F.when(v > 0, size).when(v < 0, -size), zero)


def _values(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Rows (keys, measure, v) of all measures; missing values and NaN are left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), col.cast("double").alias("v"))
            for name, col in measures.items()
        ]
    )
    return df.select(*keys, F.inline(pairs)).where(F.col("v").isNotNull() & ~F.isnan("v"))


def value_counts(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Rows (keys, measure, v, n): how often each value occurs, for all measures in one pass.

    Missing values and NaN are left out.
    """
    return _values(df, keys, measures).groupBy(*keys, "measure", "v").agg(F.count(F.lit(1)).alias("n"))


#: Keys wrapped in a struct: never NULL itself, so that one shuffle serves join and window alike.
GROUP = ["_k", "measure"]
PLACE = [*GROUP, "_bucket"]


def _bucketed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    wrapped = F.struct(*keys) if keys else F.lit(0)
    return counts.select(
        wrapped.alias("_k"), "measure", "v", "n", value_bucket(F.col("v")).alias("_bucket")
    )


def _unwrapped(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"_k.{k}").alias(k) for k in keys], *[c for c in df.columns if c != "_k"])


def _bucket_totals(bucketed: DataFrame) -> DataFrame:
    """Per bucket: rows in it, rows before it and rows of the whole group."""
    totals = bucketed.groupBy(*PLACE).agg(F.sum("n").alias("bucket_n"))
    along = Window.partitionBy(*GROUP).orderBy("_bucket")
    return totals.select(
        *PLACE,
        "bucket_n",
        (F.sum("bucket_n").over(along) - F.col("bucket_n")).alias("before"),
        F.sum("bucket_n").over(Window.partitionBy(*GROUP)).alias("group_n"),
    )


def _rows_below(bucketed: DataFrame, totals: DataFrame) -> DataFrame:
    """Per distinct value: rows of the group below it (``below``) and in the group."""
    inside = Window.partitionBy(*PLACE).orderBy("v")
    return bucketed.join(totals.select(*PLACE, "before", "group_n"), PLACE).select(
        *GROUP,
        "v",
        "n",
        (F.col("before") + F.sum("n").over(inside) - F.col("n")).alias("below"),
        "group_n",
    )


def rows_below(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Extend :func:`value_counts` with the rows below each value and the group size."""
    bucketed = _bucketed(counts, keys)
    return _unwrapped(_rows_below(bucketed, _bucket_totals(bucketed)), keys)


def _position(q: float) -> Column:
    return F.lit(float(q)) * (F.col("group_n") - 1)


def _wanted(qs: Sequence[float]) -> Column:
    """Whether a place holds a row that one of the quantiles needs."""
    start, end, found = F.col("before"), F.col("before") + F.col("bucket_n"), F.lit(False)
    for q in qs:
        for at in (F.floor(_position(q)), F.ceil(_position(q))):
            found = found | ((at >= start) & (at < end))
    return found


#: Rows of a bucket over which it is split again, and the parts that it is split into.
DENSE, PARTS = 1_000_000, 1024


def _places(rows: DataFrame, qs: Sequence[float], dense: int) -> DataFrame:
    """(_k, measure, _bucket, lo, hi, before, bucket_n, group_n): ranges of values that hold the wanted rows, written.

    Only counts per bucket, and of dense buckets per part, are shuffled.
    """
    sums = [F.count(F.lit(1)).alias("bucket_n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    kept = [*PLACE, "lo", "hi", "before", "bucket_n", "group_n"]
    totals = rows.groupBy(*PLACE).agg(*sums)
    along, whole = Window.partitionBy(*GROUP).orderBy("_bucket"), Window.partitionBy(*GROUP)
    before = F.sum("bucket_n").over(along) - F.col("bucket_n")
    placed = totals.select("*", before.alias("before"), F.sum("bucket_n").over(whole).alias("group_n"))
    places = materialise(placed.where(_wanted(qs)).select(*kept), "quantile-places")
    while True:
        crowded = places.where((F.col("bucket_n") > dense) & (F.col("hi") > F.col("lo")))
        if crowded.isEmpty():
            return places
        inside = rows.join(crowded.select(*PLACE, "lo", "hi", "before", "group_n"), PLACE)
        inside = inside.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).alias("_part")
        named = inside.select(*PLACE, F.col("lo").alias("_lo"), F.col("before").alias("_before"), "group_n", part, "v")
        parts = named.groupBy(*PLACE, "_lo", "_before", "group_n", "_part").agg(*sums)
        along = Window.partitionBy(*GROUP, "_lo").orderBy("_part")
        before = F.col("_before") + F.sum("bucket_n").over(along) - F.col("bucket_n")
        split = parts.withColumn("before", before).where(_wanted(qs)).select(*kept)
        calm = places.where((F.col("bucket_n") <= dense) | (F.col("hi") <= F.col("lo")))
        places = materialise(calm.select(*kept).unionByName(split), "quantile-places")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Column], qs: Sequence[float], dense: int = DENSE
) -> DataFrame:
    """One row per group with the quantiles of every measure, interpolated linearly.

    The result has the keys and ``{measure}_q0``, ``{measure}_q1``, ... in the order of ``qs``.
    Groups with no usable value of any measure are absent (without keys: one row of NULLs).
    The places of the wanted rows are found first, by counts; then only rows in them are shuffled and sorted.
    """
    wrapped = F.struct(*keys) if keys else F.lit(0)
    rows = _values(df, keys, measures).select(wrapped.alias("_k"), "measure", "v", value_bucket(F.col("v")).alias("_bucket"))
    places = _places(rows, qs, dense)
    # the bucket is a key of the join, so that a group of most rows is spread where places are too many to broadcast
    near = rows.join(places.select(*PLACE, "lo", "hi", "before", "group_n"), PLACE)
    near = near.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    counts = near.groupBy(*GROUP, "lo", "before", "group_n", "v").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*GROUP, "lo").orderBy("v")
    ranked = counts.withColumn("below", F.col("before") + F.sum("n").over(inside) - F.col("n"))

    def element(measure: str, index: Column) -> Column:
        here = (F.col("measure") == measure) & (F.col("below") <= index) & (index < F.col("below") + F.col("n"))
        return F.max(F.when(here, F.col("v")))

    parts, results = [], []
    for name in measures:
        for i, q in enumerate(qs):
            lo, hi, at = f"_{name}_lo{i}", f"_{name}_hi{i}", f"_{name}_at{i}"
            pos = _position(q)
            parts += [
                element(name, F.floor(pos)).alias(lo),
                element(name, F.ceil(pos)).alias(hi),
                F.max(F.when(F.col("measure") == name, pos - F.floor(pos))).alias(at),
            ]
            results.append((F.col(lo) + (F.col(hi) - F.col(lo)) * F.col(at)).alias(f"{name}_q{i}"))
    grouped = ranked.groupBy("_k") if keys else ranked.groupBy()
    picked = grouped.agg(*parts)
    return picked.select(*[F.col(f"_k.{k}").alias(k) for k in keys], *results)


def with_quantiles(
    summary: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, Column],
    q: float = 0.5,
) -> DataFrame:
    """Add one exact quantile per measure to a per-key summary; the columns take the measures' names."""
    quantiles = exact_quantiles(df, keys, columns, [q])
    named = quantiles.select(
        *[F.col(k).alias(f"_q_{k}") for k in keys], *[F.col(f"{c}_q0").alias(c) for c in columns]
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_q_{k}"))
    return summary.join(named, cond, "left").drop(*[f"_q_{k}" for k in keys])
