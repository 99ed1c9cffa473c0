"""Training, scoring and persisting the skip classifier with Spark ML."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators import evaluate, splits
from playlens.operators.features import FEATURE_COLUMNS

# --- fixed values: training settings ---------------------------------------------------------------
CHAMPION = {"maxIter": 150, "maxDepth": 4, "stepSize": 0.03, "minInstancesPerNode": 20, "subsamplingRate": 0.80, "featureSubsetStrategy": "0.5"}
CHALLENGER = {"maxIter": 220, "maxDepth": 7, "stepSize": 0.015, "minInstancesPerNode": 6, "featureSubsetStrategy": "0.65"}
HIGH_RECALL = {"maxIter": 250, "maxDepth": 8, "stepSize": 0.02, "minInstancesPerNode": 2, "featureSubsetStrategy": "0.75"}
HIGH_RECALL_WEIGHT = 22.0
SEED = 42


def _assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def skip_weight(train: DataFrame) -> float:
    return float(splits.class_weights(train).first()["scale_pos_weight"])


def train_forest(train: DataFrame, features=tuple(FEATURE_COLUMNS), trees: int = 100, depth: int = 10) -> PipelineModel:
    """Random forest with both classes weighted to the same total."""
    c = splits.class_weights(train).first()
    total = c["positives"] + c["negatives"]
    weight = F.when(F.col("is_skip") == 1, total / (2.0 * max(1, c["positives"]))).otherwise(total / (2.0 * max(1, c["negatives"])))
    forest = RandomForestClassifier(labelCol="is_skip", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED)
    return Pipeline(stages=[_assembler(features), forest]).fit(train.withColumn("weight", weight))


def train_boosted(train: DataFrame, settings: dict, features=tuple(FEATURE_COLUMNS), weight: float | None = None) -> PipelineModel:
    """Cost-sensitive boosted trees; positives weigh negatives / positives unless given."""
    weighted = splits.with_weight(train, skip_weight(train) if weight is None else weight)
    gbt = GBTClassifier(labelCol="is_skip", featuresCol="features", weightCol="weight", seed=SEED, **settings)
    return Pipeline(stages=[_assembler(features), gbt]).fit(weighted)


def train_high_recall(train: DataFrame, settings: dict | None = None, features=tuple(FEATURE_COLUMNS)) -> PipelineModel:
    return train_boosted(train, settings or HIGH_RECALL, features, max(HIGH_RECALL_WEIGHT, 2 * skip_weight(train)))


def score(model: PipelineModel, df: DataFrame, name: str, keep=("user_id", "event_id")) -> DataFrame:
    scored = model.transform(df)
    prob = vector_to_array("probability")[1]
    return scored.select(*keep, F.col("is_skip").alias("label"), F.lit(name).alias("model"), prob.alias("score"))


def scorer(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Adds ``prob`` to feature rows, as the queue forecast asks for."""
    return lambda rows: model.transform(rows).withColumn("prob", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def importances(model: PipelineModel, features=tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Feature importances: as many rows as features, sorted."""
    spark = SparkSession.active()
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def model_metrics(scored: DataFrame, threshold: float, split: str) -> DataFrame:
    """AUC and the report at a threshold, one row per model."""
    report = evaluate.confusion_report(scored, threshold).where("label = 1")
    auc = evaluate.roc_auc(scored)
    return auc.join(report, "model").select(
        "model",
        F.lit(split).alias("split"),
        "roc_auc",
        "precision",
        "recall",
        "f1",
        F.lit(threshold).alias("threshold"),
        (F.col("positives") + F.col("negatives")).alias("records"),
    )


def tune_temporal(train: DataFrame, valid: DataFrame, grid: dict[str, list], floor: float = 0.80, features=tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Grid search on a fixed later fold: the best trial has the largest recall whose precision reaches the
    floor (0 when none does). One row per trial."""
    spark = train.sparkSession
    names, trials = list(grid), []
    for i, values in enumerate(itertools.product(*grid.values())):
        settings = dict(zip(names, values))
        model = train_boosted(train, settings, features)
        scored = score(model, valid, f"trial_{i}")
        best = evaluate.threshold_precision_floor(scored, floor).first()
        safe = best is not None and best["meets_floor"] == 1
        trials.append((i, str(settings), float(best["recall"]) if safe else 0.0, float(best["threshold"]) if best else 0.0))
    return spark.createDataFrame(trials, "trial int, settings string, safe_recall double, threshold double")


def save_model(model: PipelineModel, path: str, threshold: float, metrics: dict, features=tuple(FEATURE_COLUMNS)) -> None:
    """The fitted pipeline, and beside it one row with features, threshold and metrics."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    row = [(list(features), float(threshold), "is_skip", {k: float(v) for k, v in metrics.items()})]
    meta = spark.createDataFrame(row, "features array<string>, threshold double, target string, metrics map<string,double>")
    meta.withColumn("created_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(spark: SparkSession, path: str):
    """(pipeline, metadata row)"""
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/metadata").first()
