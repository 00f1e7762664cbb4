"""Expected execution time of a query: a mean model and a high-quantile model on the log scale."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsight import schema as S
from logsight.functions import values as V
from logsight.operators.features import FeatureSpec, feature_spec, fingerprint_counts, prepare
from logsight.operators.order_stats import exact_quantiles
from logsight.operators.sampling import sample_rows
from logsight.plans.boosting import Boosted, Boosting, boost, boost_mean, calibrated, pinball, softmax
from logsight.scratch import Scratch, materialise, scratch_dir

#: Stands for a missing number: trees split it off, and the indicator columns name it.
MISSING = -1.0
#: Code of a category not seen in training.
UNSEEN = -1.0
#: Rows of a task in training; no more tasks than cores.
TASK_ROWS = 8192


@dataclass(frozen=True)
class ModelConfig:
    """Fixed values of training and prediction."""

    stage: str = S.STAGE
    target: str = S.TARGET
    quantile: float = 0.90
    explode_threshold_ms: float = 600_000.0
    rare_below: int = 3
    drop_cached_train: bool = False
    drop_aborted: bool = True
    train_window_days: int = 14
    #: Rows that models are fitted on, a fixed sample of the window; fingerprints are counted over all of it.
    max_train_rows: int = 400_000
    min_train_rows: int = 500
    conservative: bool = True
    min_pred_ms: float = 1.0
    train_classifiers: bool = False
    # tree settings
    max_depth: int = 6
    max_iter: int = 500
    step_size: float = 0.05
    min_leaf_rows: int = 50
    validation_fraction: float = 0.1
    #: Boosting ends when the held-out loss has not fallen by a millionth in so many rounds.
    patience: int = 15
    #: The quantile of what the mean misses has fewer, larger steps: its leaves are exact quantiles.
    quantile_step: float = 0.2
    quantile_iter: int = 64
    quantile_patience: int = 6
    quartile_step: float = 0.3
    quartile_iter: int = 40
    quartile_patience: int = 4
    classifier_depth: int = 8
    classifier_iter: int = 250
    classifier_step: float = 0.08
    classifier_leaf_rows: int = 80
    seed: int = 0


@dataclass
class StageModels:
    """Everything scoring needs; mean is the expected time, high the quantile of what it misses, on the log scale."""

    config: ModelConfig
    spec: FeatureSpec
    fingerprints: DataFrame
    indexer: StringIndexerModel
    mean: GBTRegressionModel
    high: Boosted
    explode: GBTClassificationModel | None = None
    quartile: Boosted | None = None
    quartile_edges: list[float] = field(default_factory=list)


def _coded(name: str) -> str:
    return f"_code_{name}"


def encode(df: DataFrame, spec: FeatureSpec, indexer: StringIndexerModel) -> DataFrame:
    """Add the feature vector: category codes (unseen is -1), then the numbers."""
    coded = indexer.transform(df)
    codes = {}
    for name, labels in zip(spec.categorical, indexer.labelsArray):
        c = F.col(_coded(name))
        codes[f"_x_{name}"] = F.when(c < len(labels), c).otherwise(F.lit(UNSEEN))
    numbers = {f"_x_{n}": F.coalesce(F.col(n).cast("double"), F.lit(MISSING)) for n in spec.numeric}
    inputs = {**codes, **numbers}
    return (
        VectorAssembler(inputCols=list(inputs), outputCol="features")
        .transform(coded.withColumns(inputs))
        .drop(*inputs, *[_coded(n) for n in spec.categorical])
    )


def fit_indexer(df: DataFrame, spec: FeatureSpec) -> StringIndexerModel:
    return StringIndexer(
        inputCols=spec.categorical,
        outputCols=[_coded(c) for c in spec.categorical],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(df)


def quartile_edges(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Exact quartiles of the target as one row (q25, q50, q75)."""
    y = F.greatest(F.coalesce(F.col(target).cast("double"), F.lit(0.0)), F.lit(0.0))
    row = exact_quantiles(df, [], {"y": y}, [0.25, 0.5, 0.75])
    return row.toDF("q25", "q50", "q75")


def quartile_label(y: Column, q25: Column, q50: Column, q75: Column) -> Column:
    """0 to 3; a value on an edge belongs to the lower quartile."""
    return F.when(y <= q25, 0).when(y <= q50, 1).when(y <= q75, 2).otherwise(3)


def explode_label(y: Column, threshold_ms: float) -> Column:
    return (y >= threshold_ms).cast("int")


def _over_cores(prepared: DataFrame) -> DataFrame:
    """Rows dealt evenly over as many tasks as pay; a scan of written rows packs all of them into a few."""
    tasks = -(-prepared.count() // TASK_ROWS)
    return prepared.repartition(max(1, min(tasks, prepared.sparkSession.sparkContext.defaultParallelism)), "query_id")


def train(prepared: DataFrame, fingerprints: DataFrame, config: ModelConfig) -> StageModels | None:
    """Fit all models of a stage on prepared rows; None when there are too few."""
    spec = feature_spec(config.stage, config.target)
    indexer = fit_indexer(prepared, spec)
    held_out = F.pmod(F.xxhash64(F.lit(config.seed), "query_id"), F.lit(1000)) < int(1000 * config.validation_fraction)
    frame = (
        encode(_over_cores(prepared), spec, indexer)
        .select(
            "features",
            F.col(config.target).cast("double").alias("y_ms"),
            V.log_target(F.col(config.target)).alias("label"),
            held_out.alias("held_out"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        if frame.count() < config.min_train_rows:
            return None
        growth = Boosting(
            config.max_depth, config.max_iter, config.step_size, config.min_leaf_rows, config.patience,
            cut_every=config.patience + 5, seed=config.seed,
        )
        mean, _ = boost_mean(frame, growth)
        missed = mean.setPredictionCol("_mean_log").transform(frame).withColumn("label", F.col("label") - F.col("_mean_log"))
        finer = Boosting(
            config.max_depth, min(config.quantile_iter, config.max_iter), config.quantile_step, config.min_leaf_rows,
            config.quantile_patience, cut_every=config.quantile_patience + 2, seed=config.seed,
        )
        models = StageModels(
            config=config,
            spec=spec,
            fingerprints=fingerprints,
            indexer=indexer,
            mean=mean,
            high=calibrated(boost(missed, pinball(config.quantile), finer), missed, config.quantile),
        )
        if config.train_classifiers:
            _fit_classifiers(frame, models)
        return models
    finally:
        frame.unpersist()


def _fit_classifiers(frame: DataFrame, models: StageModels) -> None:
    c = models.config
    edges = quartile_edges(frame, "y_ms").first()
    models.quartile_edges = list(edges)
    growth = Boosting(
        c.classifier_depth, min(c.quartile_iter, c.classifier_iter), c.quartile_step, c.classifier_leaf_rows,
        c.quartile_patience, cut_every=c.quartile_patience + 2, seed=c.seed,
    )
    quarter = quartile_label(F.col("y_ms"), *map(F.lit, edges)).cast("double")
    models.quartile = boost(frame.withColumn("label", quarter), softmax(4), growth)
    sc = frame.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:  # Spark's own boosting cuts its lineage there
        sc.setCheckpointDir(scratch_dir(frame.sparkSession))
    labelled = frame.withColumn("explodes", explode_label(F.col("y_ms"), c.explode_threshold_ms))
    if labelled.agg(F.count_distinct("explodes")).first()[0] == 2:
        boosted = GBTClassifier(
            labelCol="explodes",
            maxDepth=c.classifier_depth,
            maxIter=c.classifier_iter,
            stepSize=c.classifier_step,
            minInstancesPerNode=c.classifier_leaf_rows,
            seed=c.seed,
            predictionCol="_explodes",
        )
        boosted = boosted.setRawPredictionCol("_explodes_raw").setProbabilityCol("_explodes_p")
        models.explode = boosted.fit(labelled)


def predict(models: StageModels, prepared: DataFrame) -> DataFrame:
    """Add predictions in ms to prepared rows: mean, quantile, and the larger of both if conservative."""
    c = models.config
    kept = prepared.columns
    df = encode(prepared, models.spec, models.indexer)
    df = models.high.predict(models.mean.setPredictionCol("_mean_log").transform(df), "_missed_log")
    mean_ms = V.from_log(F.col("_mean_log"), c.min_pred_ms)
    q_ms = V.from_log(F.col("_mean_log") + F.col("_missed_log"), c.min_pred_ms)
    p_explode, quartile = F.lit(0.0), F.lit(0).cast("long")
    if models.explode is not None:
        df = models.explode.transform(df)
        p_explode = vector_to_array("_explodes_p")[1]
    if models.quartile is not None:
        df = models.quartile.predict(df, "_quartile")
        quartile = F.col("_quartile")
    df = df.withColumns({"pred_mean_ms": mean_ms, "pred_q_ms": q_ms, "p_explode": p_explode, "pred_quartile": quartile})
    used = F.greatest("pred_mean_ms", "pred_q_ms") if c.conservative else F.col("pred_mean_ms")
    return df.withColumn("pred_execution_ms", used).select(
        *kept, "pred_mean_ms", "pred_q_ms", "pred_execution_ms", "p_explode", "pred_quartile"
    )


def train_on(raw: DataFrame, config: ModelConfig) -> StageModels | None:
    """Count fingerprints over all rows, sample, prepare and fit; None when too few usable rows remain."""
    needed = raw.select(*[c for c in S.scoring_columns(config.target) if c in raw.columns])
    fingerprints = materialise(fingerprint_counts(needed), "fingerprints")
    with Scratch(raw.sparkSession) as keep:
        prepared = prepare(
            keep(sample_rows(needed, config.max_train_rows, seed=config.seed), "sample"),
            fingerprints,
            feature_spec(config.stage, config.target),
            config.rare_below,
            drop_cached=config.drop_cached_train,
            drop_aborted=config.drop_aborted,
        )
        return train(keep(prepared, "prepared"), fingerprints, config)


def score(models: StageModels, raw: DataFrame) -> DataFrame:
    """Raw events to rows with predictions; cached queries are kept."""
    c = models.config
    prepared = prepare(raw, models.fingerprints, models.spec, c.rare_below, drop_aborted=c.drop_aborted)
    return predict(models, prepared)


# --- keeping models ----------------------------------------------------------------------------


def save_models(models: StageModels, path: str) -> None:
    spark = models.fingerprints.sparkSession
    models.indexer.write().overwrite().save(f"{path}/indexer")
    models.mean.write().overwrite().save(f"{path}/mean")
    models.high.save(spark, f"{path}/high")
    if models.explode is not None:
        models.explode.write().overwrite().save(f"{path}/explode")
    if models.quartile is not None:
        models.quartile.save(spark, f"{path}/quartile")
    models.fingerprints.write.mode("overwrite").parquet(f"{path}/fingerprints")
    about = {
        "config": asdict(models.config),
        "quartile_edges": models.quartile_edges,
        "has_explode": models.explode is not None,
        "has_quartile": models.quartile is not None,
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{path}/about")


def load_models(spark: SparkSession, path: str) -> StageModels:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    config = ModelConfig(**about["config"])
    return StageModels(
        config=config,
        spec=feature_spec(config.stage, config.target),
        fingerprints=spark.read.parquet(f"{path}/fingerprints"),
        indexer=StringIndexerModel.load(f"{path}/indexer"),
        mean=GBTRegressionModel.load(f"{path}/mean"),
        high=Boosted.load(spark, f"{path}/high"),
        explode=GBTClassificationModel.load(f"{path}/explode") if about["has_explode"] else None,
        quartile=Boosted.load(spark, f"{path}/quartile") if about["has_quartile"] else None,
        quartile_edges=about["quartile_edges"],
    )
