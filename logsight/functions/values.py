"""Typing and cleaning of single values, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The spellings read as true.
TRUE_WORDS = ("1", "t", "true", "y", "yes")
# The spellings of an empty id list.
EMPTY_WORDS = ("", "nan", "None")


def type_of(df: DataFrame, name: str) -> T.DataType | None:
    return df.schema[name].dataType if name in df.columns else None


def to_bool(col: Column, dtype: T.DataType | None) -> Column:
    """Boolean from a boolean, a number or a word; a missing column is false."""
    if dtype is None:
        return F.lit(False)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(col != 0, F.lit(False))
    return F.coalesce(F.lower(F.trim(col.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def to_number(col: Column) -> Column:
    """Number or NULL: text that is no number and NaN both count as missing."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_long(col: Column, dtype: T.DataType | None = None) -> Column:
    """Whole number or NULL; text is read as a number first."""
    if isinstance(dtype, T.IntegralType):
        return col.cast("long")
    return F.coalesce(col.try_cast("long"), col.try_cast("double").try_cast("long"))


def to_timestamp(col: Column, dtype: T.DataType | None) -> Column:
    """Timestamp from ISO text or a timestamp; text without a zone is UTC."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    return F.try_to_timestamp(col.cast("string"))


def ids_to_csv(col: Column, dtype: T.DataType | None) -> Column:
    """Comma-joined ids from a list or from text; NULL becomes empty text."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.array_join(F.transform(col, lambda x: x.cast("string")), ","), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def to_id_list(col: Column, dtype: T.DataType | None) -> Column:
    """List of text ids from a list or a single value; NULL becomes an empty list."""
    if isinstance(dtype, T.ArrayType):
        ids = F.transform(col, lambda x: x.cast("string"))
    else:
        ids = F.when(col.isNotNull(), F.array(col.cast("string")))
    return F.coalesce(ids, F.array().cast("array<string>"))


def csv_count(col: Column) -> Column:
    """Number of ids in comma-joined text; blank text has none."""
    text = F.trim(F.coalesce(col.cast("string"), F.lit("")))
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return F.when(text.isin(*EMPTY_WORDS), F.lit(0)).otherwise(commas + 1).cast("int")


def day_from_name(name: Column) -> Column:
    """First YYYY-MM-DD in a file name as a date, NULL when there is none."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with an explicit UTC offset (the session runs in UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def ratio(part: Column, whole: Column) -> Column:
    """Part of a whole as a double, NULL when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def finite(col: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def finite_report(df: DataFrame) -> DataFrame:
    """Replace NaN and infinities by NULL in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(F.col(c)) for c in floats})


def log_target(y: Column) -> Column:
    """log(1 + y) of a duration, with missing and negative values read as zero."""
    return F.log1p(F.greatest(F.coalesce(y.cast("double"), F.lit(0.0)), F.lit(0.0)))


def from_log(pred: Column, floor_ms: float = 1.0) -> Column:
    """Milliseconds of a log-scale prediction, kept in range and above a floor."""
    bounded = F.least(F.greatest(pred, F.lit(-50.0)), F.lit(50.0))
    return F.greatest(F.expm1(bounded), F.lit(float(floor_ms)))


def add_missing(df: DataFrame, names: list[str], value: Column) -> DataFrame:
    """Add the named columns that are absent, all with the same value."""
    absent = {c: value for c in names if c not in df.columns}
    return df.withColumns(absent) if absent else df
