"""Model fitting, cross-validation and search on Spark ML."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F


class Unsummarised(LogisticRegression):
    """Models without the summary of their training; it holds the session, which tasks cannot be sent once it has observed a query."""

    def _fit(self, dataset: DataFrame) -> Model:
        model = super()._fit(dataset)
        model._java_obj.setSummary(dataset.sparkSession._jvm.scala.Option.empty())
        return model


def logistic(iterations: int = 10, **params) -> LogisticRegression:
    return Unsummarised(labelCol="label", featuresCol="features", maxIter=iterations, **params)


def logistic_grid(lr: LogisticRegression, regs=(0.01, 0.5, 2.0), nets=(0.0, 0.5, 1.0), iterations=(1, 5, 10)) -> list:
    return (ParamGridBuilder().addGrid(lr.regParam, list(regs)).addGrid(lr.elasticNetParam, list(nets))
            .addGrid(lr.maxIter, list(iterations)).build())


def boosted_classifier(label: str = "label", iterations: int = 10, seed: int = 7, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", maxIter=iterations, seed=seed, **params)


def boosted_regressor(label: str, seed: int = 7, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", seed=seed, **params)


def forest_regressor(label: str, bins: int = 40, seed: int = 7, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol="features", maxBins=bins, seed=seed, **params)


def depth_grid(gbt: GBTRegressor, depths=(2, 5), iterations=(10, 100)) -> list:
    return ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxIter, list(iterations)).build()


class SideBySide(CrossValidator):
    """Cross-validation that fits the models of all folds side by side, and not one fold after the other.

    A boosted model is a long row of small jobs, which leave cores idle.  ``ahead`` also fits every point on all rows meanwhile,
    and not only the best one at the end, so that no such row follows the scores.
    """

    ahead = False

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, grid, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        folds = [(train.cache(), held.cache()) for train, held in self._kFold(dataset)]
        here = inheritable_thread_target(dataset.sparkSession)

        def score(train: DataFrame, held: DataFrame, params: dict) -> float:
            return evaluator.evaluate(estimator.fit(train, params).transform(held, params))

        try:
            with ThreadPoolExecutor(self.getParallelism()) as pool:
                scores = [[pool.submit(here(score), *fold, params) for params in grid] for fold in folds]
                whole = [pool.submit(here(estimator.fit), dataset, params) for params in grid if self.ahead]
                metrics, deviations = self._gen_avg_and_std_metrics([[s.result() for s in row] for row in scores])
                best = int(np.argmax(metrics) if evaluator.isLargerBetter() else np.argmin(metrics))
                model = whole[best].result() if whole else estimator.fit(dataset, grid[best])
        finally:
            for df in (df for fold in folds for df in fold):
                df.unpersist()
        return self._copyValues(CrossValidatorModel(model, metrics, None, deviations))


def cross_validated(estimator: Estimator, grid: list, evaluator: Evaluator, folds: int, train: DataFrame,
                    parallelism: int = 4, seed: int = 36, fold: str = "") -> CrossValidatorModel:
    """Best model over a grid; the estimator may be a model or a whole pipeline. Folds are random unless a column names them."""
    return SideBySide(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                      parallelism=parallelism, seed=seed, foldCol=fold).fit(train)


def inside_pipeline(stages: list, estimator: Estimator, grid: list, evaluator: Evaluator, folds: int,
                    train: DataFrame, parallelism: int = 4, fold: str = "", ahead: bool = False) -> Model:
    """Cross-validation as the last stage: features are fitted once, not per fold."""
    cv = SideBySide(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=36, foldCol=fold)
    cv.ahead = ahead
    return Pipeline(stages=stages + [cv]).fit(train)


def grid_scores(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """Parameters and mean metric of every grid point."""
    rows = [("; ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(m))
            for params, m in zip(model.getEstimatorParamMaps(), model.avgMetrics)]
    return spark.createDataFrame(rows, "params string, metric double")


def area_under_curve(predictions: DataFrame, label: str = "label", **params) -> float:
    return BinaryClassificationEvaluator(labelCol=label, **params).evaluate(predictions)


def regression_scores(predictions: DataFrame, label: str, weight: str | None = None) -> dict[str, float]:
    """Root of the mean squared error, and share of the variance that is explained, in one pass.

    The evaluator of Spark ML takes weights as measures of trust, by which the variance of few heavy rows is not that of all rows.
    """
    y, w = F.col(label), F.lit(1.0) if weight is None else F.col(weight)
    sums = predictions.agg(F.sum(w).alias("n"), F.sum(w * F.pow(y - F.col("prediction"), 2)).alias("error"), F.sum(w * y).alias("y"), F.sum(w * y * y).alias("yy")).first()
    return {"rmse": (sums["error"] / sums["n"]) ** 0.5, "r2": 1 - sums["error"] / (sums["yy"] - sums["y"] ** 2 / sums["n"])}


def random_grid(gbt: GBTClassifier, trials: int, seed: int = 11) -> list:
    """Random points of the search space in place of a full grid."""
    rng = random.Random(seed)
    return [{gbt.maxDepth: rng.randint(2, 5), gbt.stepSize: 10 ** rng.uniform(-2, -0.3), gbt.maxIter: rng.randint(3, 10),
             gbt.subsamplingRate: rng.uniform(0.6, 1.0)} for _ in range(trials)]


def searched(train: DataFrame, trials: int = 8, parallel: int = 4, fold: str = "", **weighted) -> CrossValidatorModel:
    """Search over boosted trees, best by area under the curve; trials run side by side."""
    gbt = boosted_classifier(**weighted)
    return cross_validated(gbt, random_grid(gbt, trials), BinaryClassificationEvaluator(**weighted), 2, train, parallel, fold=fold)
