"""The regression baseline: a random forest over assembled features, its errors and importances."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.metrics import regression_metrics
from tidemark.functions.scalar import SENTINEL

if TYPE_CHECKING:  # loaded where a model is fitted or read: it takes memory that other queries' drivers need
    from pyspark.ml import PipelineModel

#: Fixed values of the baseline.
TREES, DEPTH, MIN_LEAF, SEED = 200, 15, 2, 42


def fit_forest(train: DataFrame, features: Sequence[str], target: str, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """A forest over ``features``, nulls being the sentinel; rows without a target are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rows = train.where(F.col(target).isNotNull()).fillna(SENTINEL, list(features))
    forest = RandomForestRegressor(featuresCol="_features", labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=MIN_LEAF, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features"), forest]).fit(rows)


def evaluate(scored: DataFrame, target: str, predicted: str) -> DataFrame:
    """One row: n_rows, mae, rmse, r2, mape."""
    return scored.agg(F.count("*").alias("n_rows"), *[v.alias(k) for k, v in regression_metrics(target, predicted).items()])


def importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Features by importance, largest first."""
    return sorted(zip(features, map(float, model.stages[-1].featureImportances.toArray()), strict=True), key=lambda x: (-x[1], x[0]))


def save_model(model: PipelineModel, folder: str, features: Sequence[str], target: str, metrics: DataFrame) -> None:
    """The model, its metrics, its importances and a record of how it was made, as tables below ``folder``.

    The record is written last: a folder that has one is whole.
    """
    spark = metrics.sparkSession
    model.write().overwrite().save(f"{folder}/model")
    metrics.write.mode("overwrite").parquet(f"{folder}/metrics")
    spark.createDataFrame(importances(model, features), "feature string, importance double").write.mode("overwrite").parquet(f"{folder}/importances")
    forest = model.stages[-1]
    values = [("target", target), ("features", ",".join(features)), ("trees", str(forest.getNumTrees)), ("depth", str(forest.getOrDefault("maxDepth"))), ("seed", str(forest.getOrDefault("seed")))]
    spark.createDataFrame([*values, ("spark", spark.version)], "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/record")


def load_model(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict[str, str]]:
    """A saved model and its record; AnalysisException if the folder has no record, as it is not whole."""
    from pyspark.ml import PipelineModel

    record = {r["name"]: r["value"] for r in spark.read.parquet(f"{folder}/record").collect()}
    return PipelineModel.load(f"{folder}/model"), record
