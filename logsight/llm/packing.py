"""Harmonic packing of token sequences: pieces by reciprocal-capacity class, a fixed number to each bin."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.text import prepare, whole_text
from logsight.llm.token_files import KEPT_BYTES, kept_encoder

#: Rests of up to one part in so many of the capacity are not cut further.
FINEST = 16
#: Sequence numbers that one task may give out.
SEQUENCES = 1 << 33
WIDTH = 4

Piece = tuple[int, int, bytes, int]  # row, start, ids, tokens of the row's document


def cuts(tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(length, class) of a document's pieces; a bin of class k takes k pieces.

    Whole bins first. A rest is cut to the largest reciprocal of the capacity that it holds, again and again,
    so that k such pieces fill a bin but for k - 1 tokens at most; a rest of a sixteenth of the capacity or
    less stays whole and belongs to the class k with capacity / (k + 1) < rest <= capacity / k.
    """
    for _ in range(tokens // capacity):
        yield capacity, 1
    rest = tokens % capacity
    while rest * FINEST > capacity:
        k = -(-capacity // rest)
        yield capacity // k, k
        rest -= capacity // k
    if rest:
        yield rest, capacity // rest


class Bins:
    """The open bin of each class of one worker, and the sequences that are done."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list[Piece]] = {}
        self.done: list[tuple[Piece, int, int]] = []  # piece, sequence, offset

    def add(self, piece: Piece, k: int) -> None:
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self._close(held)
            self.open[k] = []

    def _close(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.done.append((p, self.next, at))
            at += len(p[2]) // WIDTH
        self.next += 1

    def finish(self) -> None:
        """Bins not filled: their pieces in a row, cut into full sequences and, last, powers of two."""
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(len(p[2]) for p in rest) // WIDTH
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= size
            taken = []
            while size:
                row, start, ids, tokens = rest.pop(0)
                n = min(size, len(ids) // WIDTH)
                taken.append((row, start, ids[: n * WIDTH], tokens))
                if n * WIDTH < len(ids):
                    rest.insert(0, (row, start + n, ids[n * WIDTH :], tokens))
                size -= n
            self._close(taken)
        self.open = {}


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    A row's document is the ids of its text and then end_id; a null or empty text is end_id alone. Pieces are
    cut as `cuts` says and fill bins of capacity tokens; every id is in exactly one piece, offsets in a
    sequence have no gaps. Each task packs its own rows, so nothing is shuffled and a task that is run again
    gives the same sequences. Its unfilled bins become full sequences and sequences of a power of two. ids
    are little-endian unsigned 32-bit integers. kept_bytes bounds what a worker keeps of encoded pieces (twice
    as much at most); it changes the speed only. Repeated rows and null ids are documents like any other;
    other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = kept_encoder(path, kept_bytes)
        bins = Bins(capacity, TaskContext.get().partitionId() * SEQUENCES)
        names: dict[int, object] = {}
        row = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = e.encode(text) + end
                    tokens, start = len(ids) // WIDTH, 0
                    names[row] = name
                    for length, k in cuts(tokens, capacity):
                        bins.add((row, start, ids[start * WIDTH : (start + length) * WIDTH], tokens), k)
                        start += length
                    row += 1
                if len(bins.done) >= 4096:
                    yield emit(bins, names)
        bins.finish()
        yield emit(bins, names)

    def emit(bins: Bins, names: dict) -> pa.RecordBatch:
        done, bins.done = bins.done, []
        columns = [
            pa.array([names[p[0]] for p, _, _ in done], to_arrow(id_type)),
            pa.array([p[1] for p, _, _ in done], pa.int64()),
            pa.array([len(p[2]) // WIDTH for p, _, _ in done], pa.int64()),
            pa.array([p[2] for p, _, _ in done], pa.binary()),
            pa.array([p[3] for p, _, _ in done], pa.int64()),
            pa.array([s for _, s, _ in done], pa.int64()),
            pa.array([o for _, _, o in done], pa.int64()),
        ]
        held = {p[0] for pieces in bins.open.values() for p in pieces}
        last = max(names, default=-1)
        for r in [r for r in names if r not in held and r != last]:
            del names[r]
        return pa.RecordBatch.from_arrays(columns, names=COLUMNS)

    return rows.mapInArrow(run, _schema(id_type)).withColumnRenamed("id", id_col)


COLUMNS = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _schema(id_type: T.DataType) -> T.StructType:
    kinds = [id_type, T.LongType(), T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    return T.StructType([T.StructField(n, k) for n, k in zip(COLUMNS, kinds, strict=True)])
