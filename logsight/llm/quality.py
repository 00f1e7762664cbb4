"""Text quality by compression with zstandard dictionaries of good and of bad texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight.llm.labels import Calibration, Sample, calibrate, sample
from logsight.llm.text import give_back, prepare, whole_text
from logsight.llm.token_files import release_encoders

DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass
class CompressionModel:
    """Two dictionaries and the calibration of what they make of a text."""

    good: bytes
    bad: bytes
    curve: Calibration | None = None
    _made: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return {"good": self.good, "bad": self.bad, "curve": self.curve, "_made": []}

    def features(self, texts: list[str]) -> np.ndarray:
        """The normalised difference of the compressed sizes, and the logarithm of their mean part of the text."""
        if not self._made:
            self._made += [
                zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d)) for d in (self.good, self.bad)
            ]
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            raw = text.encode()
            good, bad = (len(c.compress(raw)) for c in self._made)
            out[i] = (bad - good) / (bad + good), np.log((bad + good) / 2 / max(len(raw), 1))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return self.curve(self.features(texts))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; the texts themselves where there are too few to train one."""
    samples = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def fit(rows: Sample) -> CompressionModel:
    """Dictionaries from half of the rows, calibration on the other half."""
    first, second = rows.split(2)
    model = CompressionModel(*(_dictionary([t for t, y in zip(first.texts, first.y, strict=True) if y == k]) for k in (1, 0)))
    model.curve = calibrate(model.features(second.texts), second.y, rows.rate, degree=3)
    return model


def quality_model(
    docs: DataFrame, labels: DataFrame, learnt: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_class: int = 3000,
) -> CompressionModel:
    """The model fitted on at most per_class labelled texts of each class, where `learnt` allows the id.

    Without labels of both classes every score is the rate of label 1, or one half without any.
    """
    return fit(sample(docs, labels, label_col, learnt, per_class, id_col, text_col))


def quality_score(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> Column:
    """The chance, from 0 to 1, that a whole text has label 1; a null text is empty, an empty one has a score.

    The score depends on the text alone, so repeated rows have the same; no other column is read.
    """
    sent = prepare(docs.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release_encoders()
        for texts in batches:
            yield pd.Series(sent.value.score(texts.tolist()))
        give_back()

    return score(whole_text(text_col))
