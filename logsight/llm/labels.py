"""Training rows of document classifiers: a bounded, fixed choice of labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight.llm.text import whole_text


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


@dataclass
class Sample:
    """Labelled texts in a fixed order, and the share of label 1 among all labels that may be learnt."""

    texts: list[str]
    y: np.ndarray
    rate: float

    def split(self, every: int) -> tuple[Sample, Sample]:
        """All rows but each `every`-th of each class, and those."""
        second = np.zeros(len(self.y), bool)
        for k in (0, 1):
            second[np.flatnonzero(self.y == k)[every - 1 :: every]] = True
        return tuple(
            Sample([t for t, o in zip(self.texts, second, strict=True) if o == k], self.y[second == k], self.rate)
            for k in (False, True)
        )


def sample(
    docs: DataFrame, labels: DataFrame, label_col: str, learnt: Column, per_class: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> Sample:
    """At most per_class rows of each label, those whose ids hash lowest, among the ids that `learnt` allows.

    Ids with both labels or a null one are left out; the rate counts all labels that are left. Only the chosen
    ids (a bound of two per_class) are sent to the tasks that read the documents.
    """
    one = labels.where(learnt & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    one = one.agg(F.min(label_col).alias("y"), F.max(label_col).alias("most")).where("y = most and y in (0, 1)")
    counts = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    hashed = F.xxhash64(F.col("id").cast("string"))
    picks = [one.where(F.col("y") == k).orderBy(hashed, "id").limit(per_class).select("id", "y") for k in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).join(picked, "id")
    rows = sorted(texts.withColumn("h", hashed).dropDuplicates(["id", "text"]).collect(), key=lambda r: (r["h"], r["id"], r["text"]))
    return Sample([r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64), rate)


@dataclass
class Calibration:
    """A logistic curve over the powers of standardised features, for the natural rate of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    degree: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._terms(x) @ self.weights, -30, 30)))

    def _terms(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        terms, last = [np.ones(len(z))], [(np.ones(len(z)), 0)]
        for _ in range(self.degree):
            last = [(t * z[:, k], k) for t, lowest in last for k in range(lowest, z.shape[1])]
            terms += [t for t, _ in last]
        return np.stack(terms, axis=1)


def calibrate(x: np.ndarray, y: np.ndarray, rate: float, degree: int, ridge: float = 1.0) -> Calibration:
    """Weighted ridge logistic regression by Newton steps with halving."""
    rate = min(max(rate, 0.01), 0.99)
    scale = x.std(axis=0) if len(x) else np.ones(x.shape[1])
    out = Calibration(x.mean(axis=0) if len(x) else np.zeros(x.shape[1]), np.where(scale > 1e-9, scale, 1.0), np.zeros(0), degree)
    a = out._terms(x)
    out.weights = np.zeros(a.shape[1])
    if not len(x) or y.min() == y.max():
        out.weights[0] = np.log(rate / (1 - rate))
        return out
    share = y.mean()
    w = np.where(y == 1, rate / share, (1 - rate) / (1 - share))
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(b: np.ndarray) -> float:
        z = a @ b
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * b * b).sum())

    for _ in range(50):
        p = out(x)
        gradient = a.T @ (w * (p - y)) + penalty * out.weights
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and loss(out.weights - size * step) > loss(out.weights):
            size /= 2
        out.weights = out.weights - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return out
