"""From raw documents to packed training sequences: each stage is one operator, its decisions take effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight.llm.exact_dedup import exact_dedup, normalised, start_hash
from logsight.llm.labels import fold
from logsight.llm.near_dedup import near_dedup
from logsight.llm.packing import pack
from logsight.llm.quality import quality_model, quality_score
from logsight.llm.queries import tokenizer_path
from logsight.llm.scratch import written
from logsight.llm.suffix_dedup import suffix_dedup
from logsight.llm.text import whole_text
from logsight.session import use_utc

#: Rows without an id get one from their text, over this number and so after all others.
NO_ID = 1 << 62

#: Bytes of encoded pieces that a worker keeps while packing, beside what the stages before have left in use.
PIECES_KEPT = 32 << 20


def _key() -> Column:
    """The id of a row; equal texts without an id share one."""
    own = F.shiftrightunsigned(F.xxhash64(whole_text()), 2) + F.lit(NO_ID)
    return F.coalesce(F.col("doc_id").cast("bigint"), own)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; it learns as the query op3_quality does."""
    use_utc(spark)
    model = quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("doc_id", 5) != 0)
    return docs.where(quality_score(docs, model) >= 0.3)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space; of repeated rows one.

    Whole texts are hashed only where length and start are shared by several.
    """
    found = exact_dedup(docs.select(_key().alias("key"), "text"), id_col="key").where("kept")
    kept = found.select("key", "points", "length", "start", "digest").distinct()
    text = whole_text()
    same = [
        _key() == kept["key"],
        F.char_length(text) == kept["points"],
        F.char_length(normalised(text)) == kept["length"],
        start_hash(normalised(text)) == kept["start"],
        kept["digest"].isNull() | (F.sha2(normalised(text), 256) == kept["digest"]),
    ]
    names = [_free(docs, c) for c in kept.columns]
    met = docs.join(kept, same).select(*[docs[c] for c in docs.columns], *[kept[c].alias(n) for c, n in zip(kept.columns, names, strict=True)])
    return met.dropDuplicates(names).select(*docs.columns)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on five-word shingles."""
    key = _free(docs, "key")
    found = near_dedup(docs.select(_key().alias("key"), "text"), id_col="key", words=5, threshold=0.8)
    kept = found.where("kept").select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, _key()).join(kept, key, "left_semi").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the strings of 50 bytes that an earlier one has; n_chars follows the text."""
    others = [c for c in docs.columns if c != "text"]
    found = suffix_dedup(docs, length=50, carry=others, as_text=True)
    columns = {c: F.col("carried").getField(c) for c in others} | {"text": F.col("kept")}
    if "n_chars" in others:
        columns["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=1, kept_bytes=PIECES_KEPT)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("near dedup", dissimilar_documents),
    ("suffix-array dedup", without_repeats),
    ("packing", sequences),
]

#: SQL can express neither the models nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
