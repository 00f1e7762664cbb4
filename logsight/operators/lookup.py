"""Left lookup of per-key values that stays even when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many keys can each hold 1/MAX_HOT of all rows, so their table stays this small.
MAX_HOT = 1024


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """Left join of ``table`` (unique on ``keys``) to ``rows`` without hot shuffle partitions.

    ``weight`` counts the rows behind each key. Keys holding at least 1/``max_hot`` of the
    total are at most ``max_hot`` many, whatever the data, and are broadcast. All other keys go
    through an ordinary shuffle join, where the rows already served carry a salt from
    ``spread_by`` instead of the plain key and so spread over all tasks.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    total = table.agg(F.sum(weight).alias("t")).scalar()
    is_hot = F.col(weight) * max_hot >= total

    hot_keys = [F.col(k).alias(f"_hk_{k}") for k in keys]
    hot_values = [F.col(v).alias(f"_hv_{v}") for v in values]
    hot = table.where(is_hot).select(*hot_keys, *hot_values, F.lit(True).alias("_hot"))
    on_hot = [F.col(k) == F.col(f"_hk_{k}") for k in keys]

    cold_keys = [F.col(k).alias(f"_ck_{k}") for k in keys]
    cold_values = [F.col(v).alias(f"_cv_{v}") for v in values]
    # always 0, but not a constant: the optimizer would drop a constant from the shuffle keys
    zero = F.pmod(F.col(weight).cast("long"), F.lit(1)).cast("long")
    cold = table.where(~is_hot).select(*cold_keys, *cold_values, zero.alias("_csalt"))

    served = F.coalesce(F.col("_hot"), F.lit(False))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    # a NULL key matches nothing, so those rows are spread as well
    salt = F.when(served | no_key, F.pmod(F.xxhash64(*spread_by), F.lit(1 << 20)) + 1).otherwise(0)
    on_cold = [F.col("_salt") == F.col("_csalt")] + [F.col(k) == F.col(f"_ck_{k}") for k in keys]
    spread = rows.join(F.broadcast(hot), on_hot, "left").withColumn("_salt", salt)
    joined = spread.join(cold, on_cold, "left")
    found = [F.coalesce(F.col(f"_hv_{v}"), F.col(f"_cv_{v}")).alias(v) for v in values]
    kept = [F.col(c) for c in rows.columns if c not in values]
    return joined.select(*kept, *found)
