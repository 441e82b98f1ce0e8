"""Regression pipelines on MLlib, and their results as tables."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import QuantileDiscretizer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.features import assembler, indexer, one_hot
from weftline.session import settle

# The usual number of bins; a text column with more values needs more.
LEAST_BINS = 32
# Rows of binned features in one task of a boosted fit, whose many jobs are short.
BINNED_ROWS = 250_000
WEIGHT = "__rows"


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(label - prediction, F.lit(2.0))))


def r_squared(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and R² of a table of predictions, from two aggregates and one scalar subquery."""
    mean = df.agg(F.avg(label).alias("m")).scalar()
    residual = F.sum(F.pow(F.col(label) - F.col(prediction), F.lit(2.0)))
    total = F.sum(F.pow(F.col(label) - F.col("__mean"), F.lit(2.0)))
    return df.withColumn("__mean", mean).agg(
        rmse(F.col(label), F.col(prediction)).alias("rmse"), (1 - residual / total).alias("r2")
    )


def mean_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """The training mean as prediction for every test row, and its RMSE."""
    mean = train.agg(F.avg(label).alias("m")).scalar()
    return test.withColumn("prediction", mean).agg(
        F.max("prediction").alias("prediction"),
        rmse(F.col(label), F.col("prediction")).alias("rmse"),
    )


def evaluate(predictions: DataFrame, label: str, metric: str) -> float:
    return RegressionEvaluator(
        labelCol=label, predictionCol="prediction", metricName=metric
    ).evaluate(predictions)


def linear_pipeline(
    text: Sequence[str], numeric: Sequence[str], label: str, reg_param: float = 0.001
) -> Pipeline:
    """Index and one-hot the text columns, assemble all, fit a ridge regression."""
    inputs = [*[f"{c}_hot" for c in text], *numeric]
    stages = [indexer(text), one_hot(text)] if text else []
    model = LinearRegression(labelCol=label, featuresCol="features", regParam=reg_param)
    return Pipeline(stages=[*stages, assembler(inputs), model])


def tree_bins(train: DataFrame, text: Sequence[str]) -> int:
    """Bins for trees over these text columns: as many as the largest has distinct values, at least 32.

    The indexer keeps all values of a text column on the driver, so these must be categories.
    """
    if not text:
        return LEAST_BINS
    counts = train.agg(*[F.count_distinct(c).alias(c) for c in text]).first()
    return max(LEAST_BINS, *counts)


def tree_pipeline(
    train: DataFrame, text: Sequence[str], numeric: Sequence[str], label: str, kind: str = "tree", **params
) -> Pipeline:
    """Index the text columns, assemble, fit "tree", "forest" or "boosted"; ``train`` gives the number of bins."""
    classes = {"tree": DecisionTreeRegressor, "forest": RandomForestRegressor, "boosted": GBTRegressor}
    params = {"maxBins": tree_bins(train, text), "seed": 42, **params}
    model = classes[kind](labelCol=label, featuresCol="features", **params)
    inputs = [*[f"{c}_index" for c in text], *numeric]
    return Pipeline(stages=[*([indexer(text)] if text else []), assembler(inputs), model])


def with_log_label(df: DataFrame, label: str, into: str) -> DataFrame:
    """Add the natural logarithm of a positive label."""
    return df.withColumn(into, F.log(label))


def coefficients(model: PipelineModel, inputs: Sequence[str], spark: SparkSession) -> DataFrame:
    """Intercept and weights of the last stage, one row per term; as wide as the feature list."""
    fitted = model.stages[-1]
    rows = [("(intercept)", float(fitted.intercept))]
    rows += [(name, float(w)) for name, w in zip(inputs, fitted.coefficients, strict=True)]
    return spark.createDataFrame(rows, "term string, weight double")


def importances(model: PipelineModel, inputs: Sequence[str], spark: SparkSession) -> DataFrame:
    """Feature importances with the names of the inputs, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(inputs, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def cross_validate(
    pipeline: Pipeline,
    train: DataFrame,
    label: str,
    grid: Mapping[str, Sequence],
    folds: int = 3,
    parallelism: int = 4,
    whole_pipeline: bool = True,
):
    """Search a parameter grid of the last stage by k-fold RMSE.

    ``whole_pipeline=True`` refits the preparation per fold, which keeps folds apart;
    ``False`` prepares once and searches the last stage only, which is faster. Work is dealt as ``train`` is:
    for few files, ``session.spread`` it first.
    """
    stages = pipeline.getStages()
    model = stages[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    validator = GridSearch(
        estimator=pipeline if whole_pipeline else model,
        estimatorParamMaps=builder.build(),
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=42,
    )
    if whole_pipeline:
        return validator.fit(train)
    return Pipeline(stages=[*stages[:-1], validator]).fit(train)


class GridSearch(CrossValidator):
    """A cross validator for RMSE that does shared work once.

    A fold's preparation is fitted once for all grid points, and its prepared rows are kept. The first trees
    of a boosted model are the model of fewer iterations, so points that differ in ``maxIter`` alone share one
    fit. Fits of all folds run side by side, ``parallelism`` at a time.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, points = self.getEstimator(), self.getEstimatorParamMaps()
        stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
        shared = _shared_fits(stages[-1], points)
        errors = np.zeros((self.getNumFolds(), len(points)))
        target = inheritable_thread_target(dataset.sparkSession)
        kept: list[DataFrame] = []

        def score(task: tuple) -> None:
            fold, (prepared, rows, validation), same = task
            longest = max(same, key=lambda i: _iterations(stages[-1], points[i]))
            model = prepared.last.fit(rows, points[longest])
            if len(same) == 1:
                errors[fold, longest] = self.getEvaluator().evaluate(model.transform(validation))
                return
            squared = model.evaluateEachIteration(validation, "squared")
            for i in same:
                errors[fold, i] = math.sqrt(squared[_iterations(stages[-1], points[i]) - 1])

        try:
            folds = []
            for train, validation in self._kFold(dataset):
                prepared = _Prepared(stages, train)
                # Both are filled by the first job that needs them.
                rows = prepared.rows(train, kept)
                checked = prepared.transform(validation).select(
                    stages[-1].getLabelCol(), stages[-1].getFeaturesCol(), F.lit(1.0).alias(WEIGHT)
                )
                kept.append(checked.persist())
                folds.append((prepared, rows, checked))
            # Later points are larger as a rule, and long fits come first.
            tasks = [(k, fold, same) for same in reversed(shared) for k, fold in enumerate(folds)]
            with ThreadPool(min(self.getParallelism(), len(tasks))) as pool:
                for _ in pool.imap_unordered(target(score), tasks):
                    pass
        finally:
            for df in kept:
                df.unpersist()
        best = points[int(np.argmin(errors.mean(axis=0)))]
        whole, kept = _Prepared(stages, dataset), []
        try:
            last = whole.last.fit(whole.rows(dataset, kept), best)
        finally:
            for df in kept:
                df.unpersist()
        model = PipelineModel([*whole.fitted, last]) if isinstance(estimator, Pipeline) else last
        found = CrossValidatorModel(model, list(errors.mean(axis=0)), [], list(errors.std(axis=0)))
        return self._copyValues(found)


def _iterations(model: Estimator, point: Mapping) -> int:
    return point.get(model.getParam("maxIter"), model.getOrDefault("maxIter")) if model.hasParam("maxIter") else 0


def _shared_fits(model: Estimator, points: Sequence[Mapping]) -> list[list[int]]:
    """Grid points by index, those together that one boosted fit answers."""
    if not isinstance(model, GBTRegressor):
        return [[i] for i in range(len(points))]
    found = defaultdict(list)
    for i, point in enumerate(points):
        found[tuple(sorted((p.name, v) for p, v in point.items() if p.name != "maxIter"))].append(i)
    return list(found.values())


class _Prepared:
    """The fitted preparation of ``stages`` and the rows its last stage is to be fitted on."""

    def __init__(self, stages: Sequence, train: DataFrame) -> None:
        *before, self.last = stages
        self.binned = _bins_suffice(stages)
        if self.binned:
            before, self.last = self._with_bins(before), self.last.copy().setWeightCol(WEIGHT)
        self.fitted = Pipeline(stages=before).fit(train).stages if before else []

    def _with_bins(self, before: Sequence) -> list:
        *before, vector = before
        made = {c for stage in before for c in stage.getOutputCols()}
        self.numbers = [c for c in vector.getInputCols() if c not in made]
        self.inputs = [c if c in made else f"{c}_bin" for c in vector.getInputCols()]
        if self.numbers:
            bins = QuantileDiscretizer(
                inputCols=self.numbers,
                outputCols=[f"{c}_bin" for c in self.numbers],
                numBuckets=self.last.getMaxBins(),
                relativeError=0.1 / self.last.getMaxBins(),
            )
            before.append(bins)
        return [*before, assembler(self.inputs, vector.getOutputCol())]

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.fitted).transform(df) if self.fitted else df

    def rows(self, train: DataFrame, kept: list[DataFrame]) -> DataFrame:
        """Prepared rows, kept; for boosted trees one row per different binned features, with the mean label.

        A split of squared errors weighs nothing but the number and the sum of the labels on its two sides,
        and rows of the same bins always lie on the same side: the trees are those of all rows.
        """
        label, features = self.last.getLabelCol(), self.last.getFeaturesCol()
        if not self.binned:
            kept.append(self.transform(train).select(label, features).persist())
            return kept[-1]
        for stage in self.fitted[:-1]:
            train = stage.transform(train)
        # Else the trees would take the bins of a number for categories.
        for c in self.numbers:
            train = train.withMetadata(f"{c}_bin", {})
        mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(label))
        groups = train.groupBy(*self.inputs).agg(mean.alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT))
        groups = settle(groups, "binned")
        most = 3 * train.sparkSession.sparkContext.defaultParallelism
        tasks = max(1, min(most, math.ceil(groups.count() / BINNED_ROWS)))
        kept.append(self.fitted[-1].transform(groups).select(label, features, WEIGHT).repartition(tasks).persist())
        return kept[-1]


def _bins_suffice(stages: Sequence) -> bool:
    """Whether a boosted model on all rows is that on their bins: no draws of rows, no least number of them in a node."""
    model = stages[-1]
    return (
        isinstance(model, GBTRegressor)
        and len(stages) > 1
        and isinstance(stages[-2], VectorAssembler)
        and all(s.hasParam("outputCols") and s.isSet("outputCols") for s in stages[:-2])
        and model.getLossType() == "squared"
        and model.getSubsamplingRate() == 1
        and model.getMinInstancesPerNode() == 1
        and model.getMinInfoGain() == 0
        and not model.isDefined("weightCol")
        and not model.isDefined("validationIndicatorCol")
    )


def cv_table(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """One row per grid point: its parameters as text and the mean RMSE over the folds."""
    rows = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda e: e[0].name))
        rows.append((text, float(metric)))
    return spark.createDataFrame(rows, "params string, avg_rmse double").orderBy("avg_rmse", "params")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
