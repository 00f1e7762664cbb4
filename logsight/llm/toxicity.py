"""Toxic spans by a linear-chain conditional random field over words, and scores of whole texts.

Two states, clean and toxic. A word's features are itself and its first four, six, seven and eight bytes;
transitions are between states. Only documents are labelled: all tokens of a clean one are clean, and those of
a toxic one are not all clean. The likelihood of that is fitted, with the tokens' states summed out. Marginals come
from forward and backward passes over pieces of texts, which are joined exactly by their transfer matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight.llm.labels import Calibration, Sample, calibrate, sample
from logsight.llm.text import U64, Hashed, Texts, mix, prepare, whole_text, word_bounds

BLOCK_BYTES = 2 << 20
PIECE = 128
SLOT_BITS = 22
PREFIXES = (4, 6, 7, 8)
FEATURES = 1 + len(PREFIXES)
#: Texts that have a feature, of both classes in their proportion, added to those seen, for its first weight.
PRIOR_TEXTS = 2.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text, features) of the words in a block of texts; ASCII letters count as lower case."""
    begin, end, text = word_bounds(_LETTER[data], starts)
    hashed = Hashed(_LOWER[data])
    slices = [(begin, end), *[(begin, np.minimum(begin + n, end)) for n in PREFIXES]]
    with np.errstate(over="ignore"):
        found = [mix(hashed.slices(a, b) + U64(k + 1)) for k, (a, b) in enumerate(slices)]
    return begin, end, text, np.stack(found, axis=1) if len(begin) else np.zeros((0, FEATURES), U64)


class Chains:
    """Texts of tokens laid out in pieces of PIECE tokens."""

    def __init__(self, text: np.ndarray, n_texts: int):
        per_text = np.bincount(text, minlength=n_texts)
        pieces = -(-per_text // PIECE)
        self.first_piece = np.cumsum(pieces) - pieces
        self.pieces = pieces
        self.words = per_text
        inside = np.arange(len(text)) - (np.cumsum(per_text) - per_text)[text]
        self.row = self.first_piece[text] + inside // PIECE
        self.column = inside % PIECE
        self.count = int(pieces.sum())
        self.filled = np.zeros((self.count, PIECE), bool)
        self.filled[self.row, self.column] = True

    def laid(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self.count, PIECE))
        out[self.row, self.column] = values
        return out

    def forward_backward(self, emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of the toxic state, and the expected transitions: (token marginals, 2 x 2, log likelihood)."""
        toxic, expected, log_z = self.by_text(emission, moves)
        return toxic, expected.sum(axis=0), float(log_z.sum())

    def by_text(self, emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token marginals, and of each text the expected transitions and the logarithm of the sum over all paths."""
        x = np.exp(np.clip(self.laid(emission), -30, 30))
        n = self.count
        # transfer matrices of pieces, each divided by its sum
        m = np.broadcast_to(np.eye(2), (n, 2, 2)).copy()
        for t in range(PIECE):
            on = self.filled[:, t]
            nxt = m[on] @ moves
            nxt[:, :, 1] *= x[on, t][:, None]
            m[on] = nxt / nxt.sum(axis=(1, 2), keepdims=True)
        # states before and after each piece, along the pieces of a text; a clean token stands before the first
        enter, leave = np.zeros((n, 2)), np.ones((n, 2))
        state = np.broadcast_to(np.array([1.0, 0.0]), (len(self.pieces), 2)).copy()
        back = np.ones((len(self.pieces), 2))
        for k in range(int(self.pieces.max(initial=0))):
            on = np.flatnonzero(self.pieces > k)
            p = self.first_piece[on] + k
            enter[p] = state[on]
            s = np.einsum("ni,nij->nj", state[on], m[p])
            state[on] = s / s.sum(axis=1, keepdims=True)
            q = self.first_piece[on] + self.pieces[on] - 1 - k
            leave[q] = back[on]
            b = np.einsum("nij,nj->ni", m[q], back[on])
            back[on] = b / b.sum(axis=1, keepdims=True)
        alpha = np.zeros((n, PIECE, 2))
        log_z = np.zeros(n)
        s = enter
        for t in range(PIECE):
            on = self.filled[:, t]
            a = s @ moves
            a[:, 1] *= x[:, t]
            total = a.sum(axis=1, keepdims=True)
            log_z[on] += np.log(total[on, 0])
            s = np.where(on[:, None], a / total, s)
            alpha[:, t] = s
        toxic = np.zeros((n, PIECE))
        expected = np.zeros((n, 2, 2))
        b = leave
        for t in range(PIECE - 1, -1, -1):
            on = self.filled[:, t]
            p = alpha[:, t] * b
            toxic[:, t] = p[:, 1] / p.sum(axis=1)
            before = alpha[:, t - 1] if t else enter
            after = b.copy()
            after[:, 1] *= x[:, t]
            pair = before[:, :, None] * moves[None] * after[:, None, :]
            expected[on] += pair[on] / pair[on].sum(axis=(1, 2), keepdims=True)
            nb = after @ moves.T
            b = np.where(on[:, None], nb / nb.sum(axis=1, keepdims=True), b)
        owner = np.repeat(np.arange(len(self.pieces)), self.pieces)
        of_text = [np.bincount(owner, v, len(self.pieces)) for v in (*expected.reshape(n, 4).T, log_z)]
        return toxic[self.row, self.column], np.stack(of_text[:4], axis=1).reshape(-1, 2, 2), of_text[4]


@dataclass
class ToxicModel:
    """Weights of features, found by their 64-bit hashes, of transitions, and the calibration of texts."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    curve: Calibration | None = None
    _slots: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_slots": []}

    def places(self, features: np.ndarray) -> np.ndarray:
        """The index of each feature among the keys, or their number if it is unknown."""
        if not self._slots:
            slot = np.full(1 << SLOT_BITS, len(self.keys), np.int32)
            lightest_first = np.argsort(np.abs(self.weights), kind="stable")
            slot[(self.keys[lightest_first] >> U64(64 - SLOT_BITS)).astype(np.int64)] = lightest_first
            self._slots += [slot, np.append(self.keys, U64(0))]
        slot, keys = self._slots
        at = slot[(features >> U64(64 - SLOT_BITS)).astype(np.int64)]
        return np.where(keys[at] == features, at, len(self.keys))

    def emission(self, features: np.ndarray) -> np.ndarray:
        return np.append(self.weights, 0.0)[self.places(features)].sum(axis=1) + self.bias

    def marginals(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, text, chance of being toxic) of each word in a block of texts."""
        begin, end, text, features = tokens(data, starts)
        if not len(begin):
            return begin, end, text, np.zeros(0)
        chains = Chains(text, len(starts) - 1)
        return begin, end, text, chains.forward_backward(self.emission(features), self.moves)[0]

    def text_features(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of each text the logarithm of one plus its expected toxic words, and its most toxic word's marginal."""
        _, _, text, p = self.marginals(data, starts)
        out = np.zeros((len(starts) - 1, 2))
        out[:, 0] = np.log1p(np.bincount(text, weights=p, minlength=len(out)))
        np.maximum.at(out[:, 1], text, p)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return self.curve(np.concatenate([np.zeros((0, 2)), *[self.text_features(d, s) for _, _, d, s in _blocks(texts)]]))


def _blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return Texts(pa.array(texts, pa.large_string())).blocks(BLOCK_BYTES, 1 << 20)


def fit(rows: Sample, rounds: int = 30, rate: float = 0.3, ridge: float = 0.3) -> ToxicModel:
    """Fitted on three quarters of the rows by adaptive gradient steps, calibrated on the others."""
    first, second = rows.split(4)
    blocks = [(tokens(d, s), first.y[lo:hi]) for lo, hi, d, s in _blocks(first.texts)]
    keys, odds = _features(blocks, first.y)
    model = ToxicModel(keys, np.zeros(len(keys)), -7.0, np.array([[0.97, 0.03], [0.7, 0.3]]))
    made = [(Chains(text, len(y)), text, model.places(features), y == 1) for (_, _, text, features), y in blocks]
    weights = np.append(np.clip(1.5 * odds, -4, 12) / FEATURES, 0.0)
    bias, moves = model.bias, np.log(model.moves)
    power = [np.zeros(len(weights)), 0.0, np.zeros((2, 2))]
    for _ in range(rounds if 0 < first.y.sum() < len(first.y) else 0):
        g_w, g_b, g_m = ridge * weights, 0.0, np.zeros((2, 2))
        for chains, text, at, toxic in made:
            p, expected, log_z = chains.by_text(weights[at].sum(axis=1) + bias, np.exp(moves))
            # what is expected less what the label leaves: nothing in clean texts, all but the clean path in toxic ones
            clean = np.minimum(chains.words * moves[0, 0] - log_z, -1e-9)
            excess = np.where(toxic, np.exp(clean) / np.expm1(clean), 1.0)
            error = p * excess[text]
            g_w += np.bincount(at.ravel(), np.repeat(error, FEATURES), len(weights))
            g_b += error.sum()
            expected[:, 0, 0] -= chains.words
            g_m += np.einsum("n,nij->ij", excess, expected)
        g_w[-1] = 0.0
        steps = []
        for k, g in enumerate((g_w, g_b, g_m)):
            power[k] = power[k] + g * g
            steps.append(rate * g / np.sqrt(power[k] + 1e-8))
        weights, bias, moves = weights - steps[0], bias - float(steps[1]), moves - steps[2]
    model = ToxicModel(keys, weights[:-1], float(bias), np.exp(moves))
    found = np.concatenate([np.zeros((0, 2)), *[model.text_features(d, s) for _, _, d, s in _blocks(second.texts)]])
    model.curve = calibrate(found, second.y, rows.rate, degree=1, ridge=0.05)
    return model


def _features(blocks: list, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features that occur in at least three texts, and the log-odds of toxic texts among those, less that of all."""
    per_text = []
    base = 0
    for (_, _, text, features), own in blocks:
        pairs = np.unique(np.stack([np.repeat(text + base, FEATURES).astype(U64), features.ravel()], axis=1), axis=0)
        per_text.append(pairs)
        base += len(own)
    if not per_text:
        return np.zeros(0, U64), np.zeros(0)
    pairs = np.concatenate(per_text)
    keys, at, counts = np.unique(pairs[:, 1], return_inverse=True, return_counts=True)
    bad = np.bincount(at, weights=y[pairs[:, 0].astype(np.int64)], minlength=len(keys))
    enough = counts >= 3
    bad, clean = bad[enough], (counts - bad)[enough]
    share = min(max(y.mean(), 0.01), 0.99)
    odds = np.log((bad + PRIOR_TEXTS * share) / (clean + PRIOR_TEXTS * (1 - share))) - np.log(share / (1 - share))
    return keys[enough], odds


def toxicity_model(
    docs: DataFrame, labels: DataFrame, learnt: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = 1400,
) -> ToxicModel:
    """The model fitted on at most per_class labelled texts of each class, where `learnt` allows the id.

    Without labels of both classes every score is the rate of label 1, or one half without any.
    """
    return fit(sample(docs, labels, label_col, learnt, per_class, id_col, text_col))


def toxicity_score(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> Column:
    """The chance, from 0 to 1, that a whole text has label 1; a null text is empty, an empty one has a score.

    The score depends on the text alone, so repeated rows have the same; no other column is read.
    """
    sent = prepare(docs.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.score(texts.tolist()))

    return score(whole_text(text_col))


def toxic_spans(docs: DataFrame, model: ToxicModel, text_col: str = "text", at_least: float = 0.5) -> Column:
    """The words, as [start, end) in bytes of the UTF-8 text, whose marginal is at_least so high."""
    sent = prepare(docs.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("array<array<long>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list = [[] for _ in range(len(texts))]
            for lo, _, data, starts in _blocks(texts.tolist()):
                begin, end, text, p = sent.value.marginals(data, starts)
                for k in np.flatnonzero(p >= at_least):
                    out[lo + text[k]].append([int(begin[k] - starts[text[k]]), int(end[k] - starts[text[k]])])
            yield pd.Series(out)

    return spans(whole_text(text_col))
