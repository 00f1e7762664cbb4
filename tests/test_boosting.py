"""Boosted trees: losses, prefixes, what rounds bring, saving."""

import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.functions import values as V
from logsight.plans import models
from logsight.plans.boosting import Boosted, Boosting, best_prefix, boost, pinball, softmax, squared


def noise(n, salt):
    return (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(100_000)) / 100_000.0 + 5e-6).alias(n)


@pytest.fixture(scope="module")
def frame(spark):
    """A smooth surface in three numbers, with noise that grows along the third."""
    rows = spark.range(0, 4000, 1, 2).select("id", *[noise(n, i) for i, n in enumerate(["a", "b", "c", "u", "v"])])
    surface = 4 * F.sin(F.col("a") * 9) + 3 * F.col("b") * F.col("a") + F.cos(F.col("b") * 12)
    bell = F.sqrt(-2 * F.log("u")) * F.cos(2 * math.pi * F.col("v"))
    rows = rows.withColumn("label", surface + (0.2 + F.col("c")) * bell)
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    frame = rows.select("id", "c", "features", "label", (F.col("id") % 5 == 0).alias("held_out")).cache()
    frame.count()
    return frame


def test_best_prefix():
    assert best_prefix([5, 4, 3, 4, 4], 2) == (2, True)
    assert best_prefix([5, 4, 3, 4, 2], 2) == (4, False)
    assert best_prefix([5, 6, 6, 6], 3) == (0, True)


def held_loss(frame, model, loss):
    found, scores = model.scores(frame.where("held_out"))
    return found.agg(F.avg(loss.of_row(F.col("label"), scores))).first()[0]


def test_many_rounds_lower_the_squared_loss(spark, frame, tmp_path):
    b = Boosting(depth=3, rounds=12, step=0.3, leaf_rows=20, cut_every=6)
    model = boost(frame, squared(), b)
    assert model.rounds == 12 and len(model.losses) == model.rounds + 1
    assert held_loss(frame, model, squared()) == pytest.approx(model.losses[-1], rel=1e-9)
    assert model.losses[-1] < 0.5 * model.losses[1] and min(model.losses) == model.losses[-1]
    few = boost(frame, squared(), Boosting(depth=3, rounds=3, step=0.3, leaf_rows=20, cut_every=2))
    assert few.losses == pytest.approx(model.losses[:4], rel=1e-9)  # states written in between change nothing
    model.save(spark, str(tmp_path / "m"))
    again = Boosted.load(spark, str(tmp_path / "m"))
    a, b = (m.predict(frame, "p").select("id", "p") for m in (model, again))
    assert a.exceptAll(b).count() == 0


def test_quantiles_by_boosting(frame):
    q, loss = 0.9, pinball(0.9)
    model = boost(frame, loss, Boosting(depth=2, rounds=54, step=0.2, leaf_rows=60, cut_every=18))
    scored = model.predict(frame.where("held_out"), "p")
    covered = scored.groupBy((F.col("c") * 3).cast("int")).agg(F.avg((F.col("label") <= F.col("p")).cast("int")).alias("share"))
    shares = [r["share"] for r in covered.collect()]
    assert all(0.84 <= s <= 0.95 for s in shares) and 0.87 <= sum(shares) / 3 <= 0.93
    assert model.rounds > 50
    # one tree on the same rows with a quantile in each leaf
    tree = DecisionTreeRegressor(maxDepth=6, minInstancesPerNode=50, leafCol="leaf").fit(frame.where("not held_out"))
    leaves = tree.transform(frame.where("not held_out")).groupBy("leaf").agg(F.percentile("label", q).alias("p"))
    one = tree.transform(frame.where("held_out")).join(leaves, "leaf")
    assert model.losses[-1] < 0.95 * one.agg(F.avg(loss.of_row(F.col("label"), [F.col("p")]))).first()[0]


def test_quantile_holds_where_the_mean_has_learnt_its_rows_by_heart(log):
    config = models.ModelConfig(max_iter=2, max_depth=8, min_leaf_rows=1, validation_fraction=0.3, quantile_iter=2)
    rows = log.where("query_id < 2500")
    scored = models.score(models.train_on(rows, config), rows)
    apart = F.pmod(F.xxhash64(F.lit(config.seed), "query_id"), F.lit(1000)) < 300
    below = V.log_target(F.col(S.TARGET)) <= F.log1p("pred_q_ms")
    share = scored.where(apart & ~F.col("was_aborted")).agg(F.avg(below.cast("int"))).first()[0]
    assert 0.88 <= share <= 0.92


def test_training_rows_are_dealt_over_the_cores(spark, log, monkeypatch):
    seen = []

    def look(frame, growth):
        seen.append([len(p) for p in frame.select("held_out").rdd.glom().collect()])
        raise InterruptedError

    monkeypatch.setattr(models, "boost_mean", look)
    monkeypatch.setattr(models, "TASK_ROWS", 1000)
    with pytest.raises(InterruptedError):
        models.train_on(log.coalesce(1), models.ModelConfig())
    assert len(seen[0]) == 8 and max(seen[0]) < 2 * min(seen[0])


def test_classes_by_boosting(frame):
    edges = frame.where("not held_out").agg(F.percentile("label", [0.25, 0.5, 0.75])).first()[0]
    place = sum(((F.col("label") > e).cast("int") for e in edges), F.lit(0)).cast("double")
    classes = frame.withColumn("label", place)
    model = boost(classes, softmax(4), Boosting(depth=4, rounds=5, step=0.5, leaf_rows=20, cut_every=5))
    right = model.predict(classes.where("held_out"), "p").agg(F.avg((F.col("p") == F.col("label")).cast("int"))).first()[0]
    forest = RandomForestClassifier(maxDepth=4, minInstancesPerNode=20, seed=0).fit(classes.where("not held_out"))
    other = forest.transform(classes.where("held_out")).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > other and right > 0.7
    assert len(model.values) == 4 * model.rounds


def test_nothing_to_learn(spark, frame):
    flat = frame.limit(200).withColumn("label", F.lit(3.0))
    model = boost(flat, squared(), Boosting(rounds=4, cut_every=4))
    assert model.rounds == 0 and model.predict(flat, "p").select("p").distinct().collect()[0][0] == 3.0
    none_held = boost(flat.withColumn("held_out", F.lit(False)), pinball(0.5), Boosting(rounds=2, cut_every=1))
    assert none_held.rounds == 2 and none_held.losses == []
