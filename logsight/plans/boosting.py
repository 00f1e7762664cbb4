"""Gradient boosting over Spark ML trees, for losses whose leaves have values of their own.

Every round fits a tree to the negative gradient of the loss, gives each leaf the value that suits the loss (a
mean, an exact quantile of what is missed, a Newton step) and adds a part of it to the rows' scores. Scores are
carried from round to round as columns; after a number of rounds they are written, which cuts the lineage, and
the held-out losses of all these rounds are read in one job. No round is fitted twice: the ensemble that is
kept is a prefix of the trees fitted.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight.scratch import Scratch, scratch_dir

ROW = ("features", "label", "held_out")
LEAF = "_leaf"


@dataclass(frozen=True)
class Loss:
    """What a round needs of a loss; scores are one column for each output."""

    outputs: int
    #: The best constant scores, as aggregates.
    start: Callable[[Column], list[Column]]
    #: Negative gradient with regard to one output.
    gradient: Callable[[Column, list[Column], int], Column]
    #: The value of a leaf, as an aggregate over its rows.
    leaf: Callable[[Column, list[Column], int], Column]
    #: The loss of a row.
    of_row: Callable[[Column, list[Column]], Column]


def squared() -> Loss:
    return Loss(
        1,
        start=lambda y: [F.avg(y)],
        gradient=lambda y, s, k: y - s[0],
        leaf=lambda y, s, k: F.avg(y - s[0]),
        of_row=lambda y, s: (y - s[0]) * (y - s[0]),
    )


def pinball(q: float) -> Loss:
    """The loss that the q-quantile minimises. Leaves hold exact quantiles of what is missed.

    A leaf's quantile counts distinct values; training rows are bounded by a setting, so it stays small.
    """
    return Loss(
        1,
        start=lambda y: [F.percentile(y, q)],
        gradient=lambda y, s, k: F.when(y > s[0], q).otherwise(q - 1.0),
        leaf=lambda y, s, k: F.percentile(y - s[0], q),
        of_row=lambda y, s: F.when(y > s[0], (y - s[0]) * q).otherwise((s[0] - y) * (1.0 - q)),
    )


def softmax(classes: int) -> Loss:
    """Cross entropy over classes 0, 1, ...; one tree a class in each round."""

    def chance(s: list[Column], k: int) -> Column:
        top = F.greatest(*s)
        return F.exp(s[k] - top) / sum((F.exp(x - top) for x in s), F.lit(0.0))

    def gradient(y: Column, s: list[Column], k: int) -> Column:
        return F.when(y == k, 1.0).otherwise(0.0) - chance(s, k)

    def leaf(y: Column, s: list[Column], k: int) -> Column:
        g = gradient(y, s, k)
        return F.sum(g) / F.greatest(F.sum(F.abs(g) * (1.0 - F.abs(g))), F.lit(1e-6)) * ((classes - 1) / classes)

    def of_row(y: Column, s: list[Column]) -> Column:
        top = F.greatest(*s)
        own = F.element_at(F.array(*s), y.cast("int") + 1)
        return F.ln(sum((F.exp(x - top) for x in s), F.lit(0.0))) + top - own

    return Loss(
        classes,
        start=lambda y: [F.ln((F.count_if(y == k) + 1.0) / (F.count(y) + float(classes))) for k in range(classes)],
        gradient=gradient, leaf=leaf, of_row=of_row,
    )


@dataclass(frozen=True)
class Boosting:
    """How an ensemble is grown."""

    depth: int = 6
    rounds: int = 500
    step: float = 0.05
    leaf_rows: int = 50
    #: Rounds without a lower held-out loss after which growing ends.
    patience: int = 15
    #: Rounds between two written states; held-out losses are read as often.
    cut_every: int = 16
    seed: int = 0


@dataclass
class Boosted:
    """An ensemble: trees by round and output, the values of their leaves, and where scores start."""

    trees: GBTRegressionModel | None
    values: list[list[float]]
    start: list[float]
    step: float
    losses: list[float]

    @property
    def rounds(self) -> int:
        return len(self.values) // len(self.start)

    def scores(self, rows: DataFrame) -> tuple[DataFrame, list[Column]]:
        """The rows with the leaves that they reach, and the score of each output over these."""
        if self.trees is None:
            return rows, [F.lit(s) for s in self.start]
        found = self.trees.setLeafCol(LEAF).setPredictionCol("_unused").transform(rows).drop("_unused")
        k = len(self.start)
        added = F.zip_with(vector_to_array(LEAF), _constant(self.values), lambda leaf, v: F.get(v, leaf.cast("int")))
        found = found.withColumn(LEAF, added)

        def total(i: int) -> Column:
            own = F.col(LEAF) if k == 1 else F.filter(LEAF, lambda x, at: at % k == i)
            return F.lit(self.start[i]) + self.step * F.aggregate(own, F.lit(0.0), lambda a, x: a + x)

        return found, [total(i) for i in range(k)]

    def predict(self, rows: DataFrame, name: str) -> DataFrame:
        """Add the score, or of several the place of the largest, as a column."""
        found, scores = self.scores(rows)
        if len(scores) == 1:
            return found.withColumn(name, scores[0]).drop(LEAF)
        all_ = F.array(*scores)
        place = F.array_position(all_, F.array_max(all_)) - 1
        return found.withColumn(name, place.cast("long")).drop(LEAF)

    def save(self, spark: SparkSession, path: str) -> None:
        if self.trees is not None:
            self.trees.write().overwrite().save(f"{path}/trees")
        about = {"values": self.values, "start": self.start, "step": self.step, "losses": self.losses, "any": self.trees is not None}
        spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        trees = GBTRegressionModel.load(f"{path}/trees") if about.pop("any") else None
        return cls(trees=trees, **about)


def best_prefix(losses: list[float], patience: int, tol: float = 1e-6) -> tuple[int, bool]:
    """(rounds with the least held-out loss, whether it has not fallen by tol for `patience` rounds since).

    losses[0] is the loss without any round.
    """
    best, at = math.inf, 0
    for i, loss in enumerate(losses):
        if loss < best - tol:
            best, at = loss, i
        elif i - at >= patience:
            return at, True
    return at, False


def _names(round_: int, outputs: int) -> list[str]:
    return [f"_s{round_}_{k}" for k in range(outputs)]


def boost(frame: DataFrame, loss: Loss, b: Boosting = Boosting()) -> Boosted:
    """Grow an ensemble on rows (features, label, held_out) up to the round with the least held-out loss.

    Without held-out rows all rounds are kept.
    """
    spark = frame.sparkSession
    y = F.col("label")
    learnt = frame.where(~F.col("held_out"))
    start = [float(v) if v is not None else 0.0 for v in learnt.agg(*loss.start(y)).first()]
    last = _names(0, loss.outputs)
    grown = frame.select(*ROW, *[F.lit(v).alias(n) for n, v in zip(last, start, strict=True)])
    judging = not frame.where("held_out").isEmpty()
    trees, values, losses, held = [], [], [], None
    with Scratch(spark) as keep:
        while True:
            state = keep(grown.select(*ROW, *last), "boosting")
            if held is not None:
                held.unpersist()
            grown = held = state.persist(StorageLevel.MEMORY_AND_DISK)
            first = len(values) // loss.outputs
            upto = min(b.rounds, first + b.cut_every)
            for r in range(first, upto):
                before, after, base = [F.col(n) for n in last], _names(r + 1, loss.outputs), grown
                for k in range(loss.outputs):  # all trees of a round see the scores of the one before
                    goal = base.where(~F.col("held_out")).withColumn("_goal", loss.gradient(y, before, k))
                    tree = _tree(goal, b, len(trees))
                    leaves = [0.0] * ((tree.numNodes + 1) // 2)
                    found = tree.transform(goal).groupBy(LEAF).agg(loss.leaf(y, before, k).alias("v"))
                    for row in found.collect():  # at most two to the power of the depth
                        leaves[int(row[LEAF])] = float(row["v"])
                    trees.append(tree)
                    values.append(leaves)
                    score = before[k] + b.step * F.element_at(_constant(leaves), F.col(LEAF).cast("int") + 1)
                    grown = tree.transform(grown).withColumn(after[k], score).drop(LEAF, "_tree")
                last = after
            kept, ended = upto, False
            if judging:
                new = range(first + 1 if losses else 0, upto + 1)
                scores = [[F.col(n) for n in _names(r, loss.outputs)] for r in new]
                losses += grown.where("held_out").agg(*[F.avg(loss.of_row(y, s)) for s in scores]).first()
                kept, ended = best_prefix(losses, b.patience)
            if ended or upto >= b.rounds:
                break
        held.unpersist()
    n = kept * loss.outputs
    return Boosted(ensemble(spark, trees[:n], [1.0] * n), values[:n], start, b.step, losses[: kept + 1])


def calibrated(model: Boosted, frame: DataFrame, q: float) -> Boosted:
    """The model of a quantile, moved so that a share q of the held-out rows lies below its scores.

    Rows that were learnt from are missed by less than others, so a quantile of what they miss is too low. The
    row that is taken allows for a small number of held-out rows; without any the model stays as it is.
    """
    found, scores = model.scores(frame.where("held_out"))
    left = found.select((F.col("label") - scores[0]).alias("v"))
    n = left.count()
    if not n:
        return model
    shift = left.agg(F.percentile("v", min(1.0, q * (n + 1) / n))).first()[0]
    return replace(model, start=[model.start[0] + float(shift)])


def _tree(goal: DataFrame, b: Boosting, number: int) -> DecisionTreeRegressionModel:
    return DecisionTreeRegressor(
        labelCol="_goal", maxDepth=b.depth, minInstancesPerNode=b.leaf_rows, leafCol=LEAF, predictionCol="_tree",
        seed=b.seed + number,
    ).fit(goal)


def _constant(values: list) -> Column:
    """Nested lists of numbers as one constant, however long."""
    kind = "array<array<double>>" if values and isinstance(values[0], list) else "array<double>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def ensemble(spark: SparkSession, trees: list, weights: list[float]) -> GBTRegressionModel | None:
    """The trees as one model, which runs through all of them in one pass over a row."""
    if not trees:
        return None
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    models = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    sizes = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights, strict=True)):
        models[i], sizes[i] = t._java_obj, float(w)
    uid = f"boosted_{trees[0].uid.split('_')[-1]}"
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, models, sizes))


def boost_mean(frame: DataFrame, b: Boosting) -> tuple[GBTRegressionModel, list[float]]:
    """Spark's own boosting of the squared loss, continued until the held-out loss has stopped falling.

    Some rounds are fitted at a time, each time to what those before have left over, which is carried as a
    column and written in between. The trees up to the least held-out loss make the model; its losses by round
    come with it. No round is fitted twice. Each fit begins with a tree at full weight, as Spark's first does.
    """
    spark = frame.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:  # Spark's boosting cuts its lineage there
        sc.setCheckpointDir(scratch_dir(spark))
    judging = not frame.where("held_out").isEmpty()
    trees, weights, losses = [], [], []
    state = frame.select("features", F.col("label").alias("_rest"), "held_out")
    with Scratch(spark) as keep:
        while True:
            fitted = GBTRegressor(
                lossType="squared", labelCol="_rest", predictionCol="_fit", maxDepth=b.depth, stepSize=b.step,
                maxIter=min(b.cut_every, b.rounds - len(trees)), minInstancesPerNode=b.leaf_rows, seed=b.seed,
            ).fit(state.where(~F.col("held_out")))
            trees += fitted.trees
            weights += fitted.treeWeights
            kept, ended = len(trees), len(trees) >= b.rounds
            if judging:
                losses += fitted.evaluateEachIteration(state.where("held_out"), "squared")
                kept, stopped = best_prefix(losses, b.patience)
                kept, ended = kept + 1, ended or stopped
            if ended:
                break
            left = fitted.transform(state).withColumn("_rest", F.col("_rest") - F.col("_fit"))
            state = keep(left.select("features", "_rest", "held_out"), "boosting")
    return ensemble(spark, trees[:kept], weights[:kept]), losses[:kept]
