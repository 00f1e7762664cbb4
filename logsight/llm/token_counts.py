"""Token counts of whole texts, with huge texts encoded in overlapping chunks that are spliced.

Where a space stands after one character that is no white space and before another, a token ends and another
begins, whatever surrounds it: no alternative of the byte-level word pattern takes in a space after something
else, runs of white space alone excepted, and added tokens hold no spaces. Such a place is a stable boundary;
what lies between two of them is encoded alike in every text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.text import prepare, whole_text

STABLE = regex.compile(r"(?<=\S) (?=\S)")
_RUN = regex.compile(r"\s |\s\Z| \s|\A\s")
_ODD = regex.compile("[\x1c-\x1f]")
#: Parts a worker keeps for sure, of about 160 bytes; it never has more than twice as many.
CACHED = 400_000


class Counter:
    """Counts the tokens of texts by a vocabulary file's own library."""

    def __init__(self, path: str, chunk_chars: int, overlap_chars: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk_chars, overlap_chars
        self._known: dict[str, int] = {}
        self._older: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        return self.spliced(text) if len(text) > self.chunk else self.by_parts(text)

    def by_parts(self, text: str) -> int:
        """The parts between stable boundaries are encoded once each and kept while there is room."""
        if _RUN.search(text) or _ODD.search(text):
            parts = _cut(text)
        else:
            first, *rest = text.split(" ")
            parts = [first, *[" " + r for r in rest]]
        known = self._known
        if len(known) > CACHED:  # what was not used since it was full before is dropped
            self._older, self._known = known, {}
            known = self._known
        new = [p for p in dict.fromkeys(parts) if p not in known]
        known.update((p, self._older[p]) for p in new if p in self._older)
        new = [p for p in new if p not in known]
        if new:
            known.update(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return sum(map(known.__getitem__, parts))

    def spliced(self, text: str) -> int:
        """Overlapping chunks are encoded with offsets and joined at a stable boundary both agree on.

        A chunk begins at the last splice, which is a boundary of the whole text's tokens. It is followed by
        one that begins `overlap` characters before its end. Where both have a token that begins at the same
        stable boundary, all before it is counted from the first, all after it from the second. While there is
        no such place, the overlap is doubled, up to the whole chunk, and then the chunk.
        """
        total, begin, size, overlap = 0, 0, self.chunk, self.overlap
        while len(text) - begin > size:
            starts = self._starts(text, begin, begin + size)
            low = begin + size - overlap
            later = set(self._starts(text, low, min(low + size, len(text))))
            stable = {m.start() for m in STABLE.finditer(text, low + 1, begin + size - 1)}
            common = [s for s in starts if s in later and s in stable]
            if common:
                total += int(np.searchsorted(starts, common[-1]))
                begin, size, overlap = common[-1], self.chunk, self.overlap
            elif overlap < size // 2:
                overlap *= 2
            else:
                size, overlap = 2 * size, 2 * overlap
        return total + len(self._starts(text, begin, len(text)))

    def _starts(self, text: str, begin: int, end: int) -> list[int]:
        """Where the tokens of text[begin:end] begin, in ascending order."""
        offsets = self.tokenizer.encode(text[begin:end], add_special_tokens=False).offsets
        return [begin + a for a, _ in offsets]


def _cut(text: str) -> list[str]:
    places = [0, *[m.start() for m in STABLE.finditer(text)], len(text)]
    return [text[a:b] for a, b in zip(places, places[1:], strict=False)]


_COUNTERS: dict[tuple, Counter] = {}


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    chunk_chars: int = 32_768,
    overlap_chars: int = 256,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, counted on whole texts.

    path names a byte-level vocabulary file of the tokenizers library; no begin, end or other tokens are
    added, and added tokens that stand in a text count as the library takes them. Texts longer than
    chunk_chars are spliced from overlapping chunks. Null and empty texts have no tokens. Each row stands for
    itself, repeated rows and null ids too; other columns are not read and nothing is shuffled.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = path, chunk_chars, overlap_chars
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, Counter(*key))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array([counter.count(t) for t in texts], pa.int64()),
                    ],
                    names=["id", "n_bytes", "n_tokens"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
