"""Random-forest model on a feature table."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from .scenario import unit_hash


def split_by_key(df: DataFrame, key, train_share: float = 0.8, seed: str = "split") -> tuple[DataFrame, DataFrame]:
    """Split that does not depend on partitioning."""
    marked = df.withColumn("_u", unit_hash(key, seed))
    return marked.where(F.col("_u") < train_share).drop("_u"), marked.where(F.col("_u") >= train_share).drop("_u")


def _prepared(features: list[str]) -> list:
    """Stages from columns to a vector: a missing value becomes the median of its column, so no row is left out."""
    filled = [f"_{f}_filled" for f in features]
    return [
        Imputer(strategy="median", inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error"),
    ]


def fit_forest(train: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 5, seed: int = 7):
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[*_prepared(features), forest]).fit(train)


def tune_forest(train: DataFrame, features: list[str], label: str, trees: list[int], depths: list[int],
                folds: int = 3, seed: int = 7):
    """Forest with the tree count and depth that do best in cross-validation."""
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed)
    choices = ParamGridBuilder().addGrid(forest.numTrees, trees).addGrid(forest.maxDepth, depths).build()
    search = CrossValidator(
        estimator=Pipeline(stages=[*_prepared(features), forest]), estimatorParamMaps=choices,
        evaluator=RegressionEvaluator(labelCol=label), numFolds=folds, seed=seed,
    )
    return search.fit(train).bestModel


def forest_metrics(model, test: DataFrame, label: str) -> dict[str, float]:
    scored = model.transform(test)
    return {
        m: RegressionEvaluator(labelCol=label, metricName=m).evaluate(scored) for m in ("rmse", "mae", "r2")
    }


def importances(model, features: list[str]) -> dict[str, float]:
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist()))
