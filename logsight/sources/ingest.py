"""From raw messages to typed query events, keeping what had to be rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight import schema as S
from logsight.functions import values as V

BAD_JSON = "malformed_json"
BAD_TIME = "bad_timestamp"


def decode_json(messages: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON text into raw event fields plus ``raw`` and ``reject_reason``."""
    corrupt = "_corrupt"
    fields = T.StructType([*S.RAW_EVENT.fields, T.StructField(corrupt, T.StringType())])
    event = F.from_json(
        F.col(value).cast("string"),
        fields,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    # a generator keeps later filters from parsing every message a second time
    parsed = messages.select(
        F.col(value).cast("string").alias("raw"), F.explode(F.array(event)).alias("event")
    )
    bad_json = F.col("event").isNull() | F.col(f"event.{corrupt}").isNotNull()
    bad_time = F.try_to_timestamp(F.col(f"event.{S.TIME}")).isNull()
    return parsed.select(
        "raw",
        F.when(bad_json, F.lit(BAD_JSON)).when(bad_time, F.lit(BAD_TIME)).alias("reject_reason"),
        *[F.col(f"event.{f.name}").alias(f.name) for f in S.RAW_EVENT],
    )


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")


def accepted(decoded: DataFrame) -> DataFrame:
    """Typed events of the messages that could be read."""
    good = decoded.where(F.col("reject_reason").isNull()).drop("raw", "reject_reason")
    return type_events(good)


def _id_text(col: Column, dtype: T.DataType) -> Column:
    """Ids as comma-joined text; a JSON list kept as text is unpacked first."""
    if isinstance(dtype, T.ArrayType):
        return F.when(col.isNotNull(), V.ids_to_csv(col, dtype))
    as_list = F.from_json(col.cast("string"), "array<string>")
    return F.when(col.cast("string").startswith("["), F.array_join(as_list, ",")).otherwise(
        col.cast("string")
    )


def type_events(df: DataFrame) -> DataFrame:
    """One projection to the fixed event schema: absent columns become typed NULLs."""

    def typed(field: T.StructField) -> Column:
        dtype = V.type_of(df, field.name)
        if dtype is None:
            return F.lit(None).cast(field.dataType)
        col = F.col(field.name)
        if field.name in ("read_table_ids", "write_table_ids"):
            return _id_text(col, dtype)
        if isinstance(field.dataType, T.TimestampType):
            return V.to_timestamp(col, dtype)
        if isinstance(field.dataType, T.LongType):
            return V.to_long(col, dtype)
        if isinstance(field.dataType, T.DoubleType):
            return V.to_number(col)
        if isinstance(field.dataType, T.BooleanType):
            return F.when(col.isNotNull(), V.to_bool(col, dtype))
        return col.cast("string")

    return df.select(*[typed(f).alias(f.name) for f in S.QUERY_EVENT])


def landable(df: DataFrame) -> DataFrame:
    """Events worth keeping for training: neither cached nor aborted."""
    flags = [V.to_bool(F.col(c), V.type_of(df, c)) for c in S.BOOL_COLUMNS if c in df.columns]
    for flag in flags:
        df = df.where(~flag)
    return df


def normalise_batch(df: DataFrame) -> DataFrame:
    """Make a raw batch uniform for scoring: parsed time, ids as text, no missing category."""
    changes: dict[str, Column] = {}
    if S.TIME in df.columns:
        changes[S.TIME] = V.to_timestamp(F.col(S.TIME), V.type_of(df, S.TIME))
    for c in ("read_table_ids", "write_table_ids"):
        if c in df.columns:
            changes[c] = V.ids_to_csv(F.col(c), V.type_of(df, c))
    for c in ("feature_fingerprint", "query_type"):
        if c in df.columns:
            changes[c] = F.coalesce(F.col(c).cast("string"), F.lit(S.MISSING_CATEGORY))
    return df.withColumns(changes) if changes else df
