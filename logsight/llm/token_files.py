"""Token ids of documents as Parquet files in id order, laid out for reads of some rows or some columns.

A folder holds `tokens`, one file a task: the documents of a range of ids in order, with their ids as a list
column; and `files`, one row for each of them: how many documents and ids it holds and how many ids stand
before it. Ids of documents and positions rise within a file, so row groups and pages that cannot match are
skipped by their statistics and page indexes; positions are deltas, token ids a dictionary or deltas.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.bpe import byte_symbols
from logsight.llm.text import prepare, whole_text

_SPACE = regex.compile(r"\s+")
#: Separators to str.split() that are no white space to the vocabulary.
_NO_SPACE = regex.compile("[\x1c-\x1f]")
#: Longer pieces between white space are not kept.
LONGEST_KEPT = 64
#: Bytes of pieces and ids that a worker keeps for sure; it never has more than twice as many.
KEPT_BYTES = 112 << 20
#: What an entry takes besides its characters and ids.
ENTRY_BYTES = 200
#: Pieces that are one word or a word and a mark, whose letters change alone when they are lower-cased.
_PLAIN = regex.compile("[A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u017f]+[.,]?")
#: Rows, and ids over which a batch is closed.
BATCH_ROWS, BATCH_IDS = 512, 1 << 20


@dataclass(frozen=True)
class TokenLayout:
    """How the files are laid out."""

    row_group_bytes: int = 32 << 20
    page_bytes: int = 128 << 10
    page_rows: int = 2_000
    #: "dictionary" (ids of a vocabulary as bit-packed places in it) or "delta".
    ids: str = "dictionary"
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        """Settings of the Parquet writer; version 2 writes integers without a dictionary as deltas."""
        if self.ids not in ("dictionary", "delta"):
            raise ValueError(f"ids are written as dictionary or delta, not {self.ids}")
        plain = ["id", "local_start", "row"] + (["ids.list.element"] if self.ids == "delta" else [])
        return {
            "compression": self.codec,
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            # rows differ by orders of magnitude, so sizes are looked at often
            "parquet.page.size.row.check.min": "8",
            "parquet.page.size.row.check.max": "64",
            "parquet.block.size.row.check.min": "8",
            "parquet.block.size.row.check.max": "64",
            **{f"parquet.enable.dictionary#{c}": "false" for c in plain},
        }


class KeptEncoder(dict):
    """The ids of pieces between white space by the tokenizers library, as little-endian 32-bit integers.

    A word of this kind of vocabulary never spans white space, so a text's ids are those of its pieces in a row.
    Each piece is encoded once while there is room: what is kept is bounded in bytes, what was not used since
    the last time that it was full is dropped, and pieces over LONGEST_KEPT characters are encoded each time.
    """

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.symbols = self.library.model, byte_symbols()
        self.bound, self.size = kept_bytes, 0
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        pieces = [p for p in _SPACE.split(text) if p] if _NO_SPACE.search(text) else text.split()
        if self.size > self.bound:
            self.older, self.size = dict(self), 0
            self.clear()
        return b"".join(map(self.__getitem__, pieces))

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._plain(piece) if _PLAIN.fullmatch(piece) else self._any(piece)
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
            self.size += 4 * len(piece) + len(ids) + ENTRY_BYTES
        return ids

    def _any(self, piece: str) -> bytes:
        ids = self.library.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, piece: str) -> bytes:
        """The ids of a piece that needs no cutting by the library's pattern: its words go to the model as they are."""
        low = piece.lower()
        words = (low[:-1], low[-1]) if low[-1] in ".," else (low,)
        if not low.isascii():
            words = ["".join([self.symbols[b] for b in w.encode()]) for w in words]
        ids = [t.id for w in words for t in self.model.tokenize(w)]
        return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple[str, int], KeptEncoder] = {}


def kept_encoder(path: str, kept_bytes: int = KEPT_BYTES) -> KeptEncoder:
    """The encoder of a vocabulary file, made once in each worker, which keeps one at a time."""
    key = (path, kept_bytes)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = KeptEncoder(path, kept_bytes)
    return _ENCODERS[key]


def release_encoders() -> None:
    """Give up what earlier stages kept in this worker, at the start of a task that needs the memory itself."""
    _ENCODERS.clear()


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    carry: list[str] | None = None,
    files: int | None = None,
    layout: TokenLayout = TokenLayout(),
) -> None:
    """Write the ids of all rows' whole texts, and end_id after each, in ascending order of the document id.

    A null or empty text is end_id alone. Null ids come last; rows with one id stand in the order of a hash of
    their texts, equal rows in any. The key of the order includes text and place, so that an id of many rows is
    spread over files. Columns named in carry are kept beside the ids, as fields of `meta`, whatever their names;
    other columns are not read. An empty table gives a folder without rows.

    Texts are dealt out by ranges of ids into `files` files (as many as a shuffle has partitions) and encoded
    there, so each document is encoded once and one task holds one batch of them. Running a task again gives
    the same file.
    """
    spark = prepare(docs.sparkSession)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    meta = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"), meta.alias("meta"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_last("id"), F.asc("hash"), F.asc("place")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text", "meta")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(path)
        part, row, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            lo, held, size = 0, [], 0
            for at in range(0, batch.num_rows, 64):
                coded = [encoder.encode(t) + end for t in batch.column(1).slice(at, 64).to_pylist()]
                held += coded
                size += sum(map(len, coded))
                hi = lo + len(held)
                if len(held) >= BATCH_ROWS or size >= 4 * BATCH_IDS or hi == batch.num_rows:
                    out = _rows(batch.slice(lo, hi - lo), held, part, row, start)
                    yield out
                    row, start = row + len(held), start + sum(map(len, held)) // 4
                    lo, held, size = hi, [], 0

    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("row", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("local_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("meta", rows.schema["meta"].dataType),
        ]
    )
    rows.mapInArrow(run, schema).write.options(**layout.options()).parquet(f"{folder}/tokens")
    written = spark.read.parquet(f"{folder}/tokens")
    files_table = written.groupBy("part").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"),
    )
    # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    files_table.withColumn("first_position", first).coalesce(1).write.parquet(f"{folder}/files")


def _rows(batch: pa.RecordBatch, coded: list[bytes], part: int, row: int, start: int) -> pa.RecordBatch:
    counts = np.array([len(c) // 4 for c in coded], np.int64)
    ends = np.cumsum(counts)
    offsets = np.concatenate([np.zeros(1, np.int64), ends]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), np.int32)))
    columns = [
        pa.array(np.full(len(coded), part, np.int32)), pa.array(np.arange(row, row + len(coded))), batch.column(0),
        pa.array(start + ends - counts), pa.array(counts), ids, batch.column(2),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "row", "id", "local_start", "n_tokens", "ids", "meta"])


def read_tokens(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """(id, start, n_tokens, ids, meta) of the documents; start counts the ids of all documents before one.

    A condition on id or meta reaches the scan, which skips row groups and pages by it. Columns that are not
    used are not read: without ids, a read touches the metadata only.
    """
    stored = spark.read.parquet(f"{folder}/tokens")
    if where is not None:
        stored = stored.where(where)
    files = spark.read.parquet(f"{folder}/files").select("part", "first_position")
    start = F.col("first_position") + F.col("local_start")
    return stored.join(files, "part").select("id", start.alias("start"), "n_tokens", "ids", "meta")


def read_span(spark: SparkSession, folder: str, first: int, end: int) -> DataFrame:
    """(id, start, ids) of the ids at positions first to end - 1 of the whole corpus, in pieces by document.

    Files that do not overlap the span are left out by their numbers, pages of the others by their indexes.
    """
    files = spark.read.parquet(f"{folder}/files").where(
        (F.col("first_position") < end) & (F.col("first_position") + F.col("tokens") > first)
    )
    parts = {r["part"]: r["first_position"] for r in files.collect()}  # files that a span overlaps
    if not parts:
        return read_tokens(spark, folder, F.lit(False)).select("id", "start", "ids")
    near = F.lit(False)
    for part, base in parts.items():
        near = near | ((F.col("part") == part) & (F.col("local_start") < end - base) & (F.col("local_start") + F.col("n_tokens") > first - base))
    rows = read_tokens(spark, folder, near)
    lo, hi = F.greatest(F.col("start"), F.lit(first)), F.least(F.col("start") + F.col("n_tokens"), F.lit(end))
    cut = F.slice("ids", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int"))
    return rows.select("id", lo.alias("start"), cut.alias("ids"))


def with_crc32(rows: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of rows with ids: the checksum of the ids as little-endian 32-bit integers."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at = np.asarray(ids.offsets)
            raw = memoryview(np.ascontiguousarray(np.asarray(ids.values), "<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * lo : 4 * hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [*batch.columns[:3], pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids_crc32"])

    kept = rows.select("id", "start", "n_tokens", "ids")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:3], T.StructField("ids_crc32", T.LongType())]))
