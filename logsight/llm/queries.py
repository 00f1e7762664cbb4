"""The queries of this subpackage by name, and the SQL that checks those SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight.llm.bpe import encode_decode
from logsight.llm.chat import format_chats
from logsight.llm.exact_dedup import exact_dedup
from logsight.llm.filter_audit import failure_counts, filter_audit
from logsight.llm.labels import fold
from logsight.llm.near_dedup import near_dedup
from logsight.llm.packing import pack
from logsight.llm.quality import quality_model, quality_score
from logsight.llm.spelling import spelling_variants, vocabulary
from logsight.llm.suffix_dedup import suffix_dedup
from logsight.llm.token_counts import token_counts
from logsight.llm.token_files import read_tokens, with_crc32, write_tokens
from logsight.llm.topk import top_k
from logsight.llm.toxicity import toxicity_model, toxicity_score
from logsight.scratch import scratch_path
from logsight.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZERS = "public_tokenizers"
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed package of public tokenizers."""
    return importlib.import_module(TOKENIZERS).path(name)


@query
def op1_packing(spark, sf):
    """All documents in sequences of at most 2048 tokens."""
    pieces = pack(_table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_bpe(spark, sf):
    """Token ids of all documents and what they decode to, as digests."""
    coded = encode_decode(_table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _scored(docs: DataFrame, score, held_out, at_least: float) -> DataFrame:
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= at_least, 1).otherwise(0)
    )


@query
def op3_quality(spark, sf):
    """Quality scores of all documents, learnt from four fifths of the labels."""
    docs, held_out = _table(spark, sf, "documents"), fold("doc_id", 5) == 0
    model = quality_model(docs, _table(spark, sf, "labels"), ~held_out)
    return _scored(docs, quality_score(docs, model), held_out, 0.3)


@query
def op4_token_counts(spark, sf):
    """Token counts of all documents, and which have more than 512."""
    return token_counts(_table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


@query
def op5_suffix_dedup(spark, sf):
    """All documents less the 50-byte strings that an earlier one has."""
    found = suffix_dedup(_table(spark, sf, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_toxicity(spark, sf):
    """Toxicity scores of all documents, learnt from two thirds of the labels."""
    docs, held_out = _table(spark, sf, "documents"), fold("doc_id", 3) == 1
    model = toxicity_model(docs, _table(spark, sf, "labels"), ~held_out)
    return _scored(docs, toxicity_score(docs, model), held_out, 0.7)


@query
def op7_chat(spark, sf):
    """The repaired and rendered turns of all conversations, pieces as digests."""
    turns = format_chats(_table(spark, sf, "conversations"))
    return turns.withColumn("piece_sha256", F.sha2("piece", 256)).drop("piece")


@query
def op8_exact_dedup(spark, sf):
    """Groups of documents that are equal without white space."""
    found = exact_dedup(_table(spark, sf, "documents"), digest_all=True)
    return found.withColumnRenamed("digest", "text_sha256").drop("points", "length", "start")


ORACLE["op8_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (g ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (g ORDER BY points DESC, doc_id) AS kept,
       text_sha256
FROM t
WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op9_top_k(spark, sf):
    """The ten vectors with the largest inner products with each hundredth one."""
    vectors = _table(spark, sf, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


ORACLE["op9_top_k"] = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op10_near_dedup(spark, sf):
    """Groups of documents whose three-word shingle sets have a similarity of 0.85 or more."""
    return near_dedup(_table(spark, sf, "documents"), words=3, threshold=0.85)


@query
def op11_token_files(spark, sf):
    """Token ids of all documents, written as files in id order and read back: places, counts and checksums."""
    folder = scratch_path(spark, "llm-tokens")
    write_tokens(_table(spark, sf, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return with_crc32(read_tokens(spark, folder)).withColumnRenamed("id", "doc_id")


@query
def op12_filter_audit(spark, sf):
    """What five filters remove from each language in all orders."""
    return filter_audit(failure_counts(_table(spark, sf, "documents"), _table(spark, sf, "labels")))


ORACLE["op12_filter_audit"] = r"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
), failing AS (
    SELECT doc_id, part,
           [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
            regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS fails
    FROM base
), known AS (
    SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id
), masks AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0)::BIGINT AS good, coalesce(sum(toxic), 0)::BIGINT AS toxic
    FROM failing LEFT JOIN known USING (doc_id) GROUP BY part, fails
), f AS (SELECT unnest(range(1, 6)) AS f), orders AS (
    SELECT [a.f, b.f, c.f, d.f, e.f] AS o,
           'ABCDE'[a.f] || 'ABCDE'[b.f] || 'ABCDE'[c.f] || 'ABCDE'[d.f] || 'ABCDE'[e.f] AS filter_order
    FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), removals AS (
    SELECT part, filter_order, s.f AS step, o[s.f] AS filter, n, good, toxic,
           fails[o[s.f]] AS failed,
           len(list_filter(o[1:s.f - 1], lambda x: fails[x])) > 0 AS earlier,
           len(list_filter(fails, lambda x: x)) = 1 AS once
    FROM masks, orders, f s
), steps AS (
    SELECT part, filter_order, step::INTEGER AS step, filter,
           coalesce(sum(n) FILTER (NOT failed AND NOT earlier), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (failed AND NOT earlier), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (failed AND earlier), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (failed AND once), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (failed AND NOT earlier), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (failed AND NOT earlier), 0)::BIGINT AS toxic_lost
    FROM removals GROUP BY ALL
)
SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM steps
"""


@query
def op13_spelling(spark, sf):
    """The words of all documents with their spelling variants."""
    return spelling_variants(vocabulary(_table(spark, sf, "documents")))


# crc32 byte by byte over a table of 256 remainders; pairs by what is left without one code point
ORACLE["op13_spelling"] = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(r ORDER BY b) AS t FROM (
        SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS r
        FROM range(256) x(b)
    )
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS name,
           unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT name, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY name, run
), bytes AS (
    SELECT run, n, length(run) AS size,
           list_transform(range(0, strlen(name || ':' || run)),
               lambda i: ('0x' || substr(hex(name || ':' || run), 2 * i + 1, 2))::BIGINT) AS b
    FROM counted
), hashed AS (
    SELECT run, n, size,
           xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295::BIGINT), 4294967295) AS h
    FROM bytes, crc_table
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n
    FROM hashed
), v AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) u(i)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, v.word, v.n FROM cut a JOIN v ON a.rest = v.word
    UNION SELECT v.word, v.n, a.word, a.n FROM cut a JOIN v ON a.rest = v.word
), best AS (
    SELECT word, n, count(*) AS n_near, arg_min({'o': other, 'n': other_n}, {'m': -other_n, 'o': other}) AS f FROM near GROUP BY word, n
), forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN f.n >= 2 * v.n THEN f.o END AS form, CASE WHEN f.n >= 2 * v.n THEN f.n END AS form_n
    FROM v LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS at, form AS next FROM forms
    UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.next = forms.word
)
SELECT forms.*, chain.at AS root FROM forms JOIN chain ON chain.word = forms.word AND chain.next IS NULL
"""
