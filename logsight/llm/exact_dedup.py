"""Exact duplicate groups by progressive refinement: length, then a hash of the start, then of everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight.llm.scratch import written
from logsight.llm.text import whole_text

#: Characters that do not count when texts are compared: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False
) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, points, length, start) of every row.

    Texts are equal when they are so without white space. Rows are grouped by the length of that text; where
    a length is shared, by a hash of its first characters; where that is shared too, by the SHA-256 of all of
    it. A row that is alone at one step is done and its content is not hashed further: digest is then null,
    unless digest_all asks for the digest of every text, which is then taken in the same scan.

    The row with the most code points in its original text stays, then the one with the smallest id; keep_id
    is its id. Null texts are empty; null ids come last, and a group of null ids only has a null keep_id. Rows
    that agree in id and text are all marked kept if one is. Other columns are not read. points counts the
    original text, length and start (a hash) are those of the text without white space: a row without a digest
    is the only one with its length and start.

    Equal texts may be any share of all rows: groups are summed before they are shuffled, and rows meet their
    group's sum in joins whose large partitions can be split.
    """
    text = whole_text(text_col)
    bare = normalised(text)
    levels = docs.select(
        F.col(id_col).alias("id"),
        F.char_length(text).alias("points"),
        F.char_length(bare).alias("length"),
        start_hash(bare).alias("start"),
        (F.sha2(bare, 256) if digest_all else F.lit(None).cast("string")).alias("digest"),
    )
    levels = written(levels, "levels")
    shared = levels.join(_shared(levels, ["length"]), "length", "left_semi")
    starts = written(_shared(shared, ["length", "start"]), "starts")

    if digest_all:
        full = levels.join(starts, ["length", "start"], "left_semi")
    else:
        again = docs.select(
            F.col(id_col).alias("id"),
            F.char_length(text).alias("points"),
            F.char_length(bare).alias("length"),
            start_hash(bare).alias("start"),
            bare.alias("bare"),
        )
        full = again.join(starts, ["length", "start"], "left_semi").withColumn("digest", F.sha2("bare", 256))
    full = written(full.select("id", "points", "length", "start", "digest"), "full")

    # the most code points first, then the smallest id: the least of (-points, null last, id)
    order = F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("last"), F.col("id").alias("id"))
    groups = full.groupBy("length", "digest").agg(F.min(order).alias("best"), F.count("*").alias("size"))
    met = full.join(groups.where("size > 1"), ["length", "digest"], "left").select(
        "id", "digest", F.coalesce("size", F.lit(1)).alias("size"),
        F.when(F.col("size") > 1, F.col("best.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce(F.col("points") == -F.col("best.p"), F.lit(True)).alias("most"), "points", "length", "start",
    )
    alone = levels.join(starts, ["length", "start"], "left_anti").select(
        "id", "digest", F.lit(1).cast("bigint").alias("size"), F.col("id").alias("keep_id"), F.lit(True).alias("most"),
        "points", "length", "start",
    )
    return met.unionByName(alone).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & F.col("most")).alias("kept"),
        "digest", "points", "length", "start",
    )


def start_hash(bare: Column) -> Column:
    """The hash of the first characters of a text without white space."""
    return F.xxhash64(F.substring(bare, 1, PREFIX_CHARS))


def _shared(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("rows")).where("rows > 1").select(*by)
