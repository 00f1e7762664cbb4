"""Quality and toxicity models on held-out labels, and the random field against sums over all paths."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsight.llm import toxicity
from logsight.llm.labels import Sample, calibrate, fold, sample
from logsight.llm.quality import quality_model, quality_score
from logsight.llm.queries import QUERIES
from logsight.llm.toxicity import Chains, toxic_spans, toxicity_model, toxicity_score

SF = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.93)])
def test_held_out_labels(spark, name, label, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    found = QUERIES[name](spark, SF)
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "y").collect()
    score, predicted, y = (np.array([r[c] for r in rows]) for c in ("score", "predicted", "y"))
    assert len(rows) > 300 and ((score >= 0) & (score <= 1)).all()
    assert auc(score, y) > least
    assert (predicted == y).mean() > 0.93


def test_held_out_toxic_documents_are_found(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op6_toxicity"](spark, SF).where("held_out").select("doc_id", "score").join(labels, "doc_id").join(docs, "doc_id")
    rows = found.collect()
    score, y, lang = (np.array([r[c] for r in rows]) for c in ("score", "y", "lang"))
    said = score >= 0.7
    print("AUC", auc(score, y), "recall", said[y == 1].mean(), "false positives", said[y == 0].mean())
    print({k: float(said[(y == 1) & (lang == k)].mean()) for k in sorted(set(lang))})
    assert auc(score, y) > 0.95 and said[y == 1].mean() > 0.8 and said[y == 0].mean() < 0.01
    assert all(said[(y == 1) & (lang == k)].mean() > 0.4 for k in set(lang))


def test_rare_toxic_words_are_learnt():
    rng = np.random.default_rng(8)
    neutral = np.array([f"{a}{b}{c}" for a in ("ta", "mo", "ri", "du") for b in ("lan", "per", "sot") for c in ("ga", "be", "no", "ku")])
    offending, rare = [[f"{c}{stem}" for c in "abcdefghijklmnopqrst"] for stem in ("vexed", "lunar")]

    def texts(n, y):
        own = (rare, offending)[y]
        return [" ".join(rng.permutation([*rng.choice(neutral, 30), own[i * 20 // n], rare[i % 20]])) for i in range(n)]

    # each offending word is in 6 of 120 toxic texts (4 or 5 of the fitted ones), one of them in a clean text too
    clean = texts(120, 0)
    clean[0] += " " + offending[3]
    y = np.tile([0, 1], 120)
    rows = Sample([t for pair in zip(clean, texts(120, 1), strict=True) for t in pair], y, 0.5)
    model = toxicity.fit(rows)
    assert (model.score(texts(60, 1)) >= 0.7).mean() > 0.9
    assert (model.score(texts(60, 0)) >= 0.7).mean() < 0.05


def test_random_field_sums_over_all_paths():
    rng = np.random.default_rng(0)
    moves = np.array([[0.9, 0.1], [0.4, 0.6]])
    lengths = [1, 0, 7, 3]
    text = np.repeat(np.arange(4), lengths)
    emission = rng.normal(size=len(text))
    got, expected_moves, log_z = Chains(text, 4).forward_backward(emission, moves)
    at, total_z, pairs = 0, 0.0, np.zeros((2, 2))
    for n in lengths:
        weight, marginal, own_pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w, before, p = 1.0, 0, np.zeros((2, 2))
            for k, s in enumerate(path):
                w *= moves[before, s] * (np.exp(emission[at + k]) if s else 1.0)
                p[before, s] += 1
                before = s
            weight += w
            marginal += w * np.array(path)
            own_pairs += w * p
        assert np.allclose(got[at : at + n], marginal / weight)
        pairs += own_pairs / weight
        total_z += np.log(weight)
        at += n
    assert np.allclose(expected_moves, pairs) and np.isclose(log_z, total_z)


def test_long_chains_join_exactly_at_pieces(monkeypatch):
    from logsight.llm import toxicity

    rng = np.random.default_rng(3)
    text, emission = np.repeat([0, 1], [500, 37]), rng.normal(size=537)
    moves = np.array([[0.9, 0.1], [0.4, 0.6]])
    one = Chains(text, 2).forward_backward(emission, moves)
    monkeypatch.setattr(toxicity, "PIECE", 1000)
    whole = Chains(text, 2).forward_backward(emission, moves)
    assert all(np.allclose(a, b) for a, b in zip(one, whole, strict=True))


@pytest.mark.parametrize(("fit", "score", "label"), [(quality_model, quality_score, "quality"), (toxicity_model, toxicity_score, "toxic")])
def test_any_rows_have_scores(spark, docs, nothing, rows, fit, score, label):
    few = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0)], f"doc_id long, {label} int, x int")
    for labels in (few, few.where("false")):
        model = fit(docs, labels, F.lit(True))
        found = docs.withColumn("score", score(docs, model))
        got = [r.score for r in found.collect()]
        assert len(got) == len(rows) and all(0 <= s <= 1 for s in got)
        assert nothing.withColumn("score", score(nothing, model)).count() == 0


def test_spans_are_the_offending_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity_model(docs, labels, F.lit(True), per_class=500)
    made = spark.createDataFrame([(1, "Ébene thine moron, and reston"), (2, None), (3, "thine reston")], "doc_id long, text string")
    found = {r.doc_id: r.s for r in made.withColumn("s", toxic_spans(made, model)).collect()}
    assert found == {1: [[13, 18]], 2: [], 3: []}


def test_sample_is_bounded_and_leaves_conflicts_out(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(5, 0), (None, 1)], "doc_id long, y int")
    found = sample(docs, labels, "y", F.lit(True), per_class=4)
    assert sorted(found.y) == [0] * 4 + [1] * 4
    assert abs(found.rate - 14 / 29) < 1e-9
    again = sample(docs.repartition(5), labels, "y", F.lit(True), per_class=4)
    assert found.texts == again.texts


def test_calibration_of_one_class_is_its_rate():
    curve = calibrate(np.zeros((3, 2)), np.ones(3), 0.8, 2)
    assert np.allclose(curve(np.zeros((2, 2))), 0.8)


def test_folds(spark):
    r = spark.createDataFrame([(7,), (None,)], "doc_id long").select(fold("doc_id", 5).alias("f")).collect()
    import zlib

    assert [x.f for x in r] == [zlib.crc32(b"7") % 5, None]
