"""Supervised models on Spark ML: fits, grids, leaderboards, several targets, automatic choice."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hash_bucket
from ..session import cached, stage
from .evaluate import stratified_folds

# The tree grid of the cover-type study.
TREE_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [1, 20], "maxBins": [40, 300], "minInfoGain": [0.0, 0.05]}
FOREST_GRID = {"minInfoGain": [0.0, 0.05], "numTrees": [1, 10]}


def with_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(array, lambda v: v.cast("double"))))


def decision_tree(label: str = "label", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, **params)


def random_forest(label: str = "label", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, **params)


def boosted_trees(label: str = "label", trees: int = 100, depth: int = 15, rate: float = 0.01, rows: float = 1.0,
                  columns: str = "0.2", seed: int = 1) -> GBTClassifier:
    """Binary gradient boosting with row and column sampling."""
    return GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
                         featureSubsetStrategy=columns, seed=seed)


def boosted_early_stop(label: str = "label", validation: str = "valid", trees: int = 20, rate: float = 0.1, depth: int = 6,
                       rows: float = 0.75, columns: str = "0.75", tolerance: float = 0.01, seed: int = 1) -> GBTClassifier:
    """Boosting that stops when the loss on the rows flagged by ``validation`` no longer improves."""
    return GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
                         featureSubsetStrategy=columns, validationIndicatorCol=validation, validationTol=tolerance, seed=seed)


def elastic_logistic(label: str = "label", reg: float = 0.1, mix: float = 0.0, family: str = "binomial", iterations: int = 100) -> LogisticRegression:
    return LogisticRegression(labelCol=label, regParam=reg, elasticNetParam=mix, standardization=True, family=family, maxIter=iterations)


def softmax(label: str = "label", iterations: int = 100) -> LogisticRegression:
    return LogisticRegression(labelCol=label, family="multinomial", maxIter=iterations)


def gaussian_bayes(label: str = "label") -> NaiveBayes:
    return NaiveBayes(labelCol=label, modelType="gaussian")


def feed_forward(inputs: int, hidden: Sequence[int], classes: int, label: str = "label", epochs: int = 50, seed: int = 1) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, layers=[inputs, *hidden, classes], maxIter=epochs, seed=seed)


def indexed_tree(base: Estimator, categories: int = 40) -> Pipeline:
    """Treat columns with few distinct values as categories, then fit the tree model."""
    indexer = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=categories, handleInvalid="keep")
    return Pipeline(stages=[indexer, base.copy().setFeaturesCol("indexed")])


def param_grid(estimator: Estimator, grid: dict[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def _settings(param_maps) -> list[str]:
    return [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)) for m in param_maps]


def search_split(df: DataFrame, estimator: Estimator, maps: list, evaluator, ratio: float = 0.9, seed: int = 1, parallelism: int = 4):
    """Best model and leaderboard from one random training/validation split."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must leave rows for validation")
    search = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, trainRatio=ratio, seed=seed, parallelism=parallelism)
    with cached(df):
        fitted = search.fit(df)
    return fitted.bestModel, _board(df, maps, fitted.validationMetrics, evaluator)


def search_folds(df: DataFrame, estimator: Estimator, maps: list, evaluator, fold: str, folds: int, parallelism: int = 4):
    """Best model and leaderboard over given folds (column ``fold`` holds 0..folds-1)."""
    search = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol=fold, parallelism=parallelism)
    with cached(stage(df, "folds")) as rows:
        fitted = search.fit(rows)
    return fitted.bestModel, _board(df, maps, fitted.avgMetrics, evaluator)


def _board(df: DataFrame, maps, metrics, evaluator) -> DataFrame:
    rows = [(s, float(m)) for s, m in zip(_settings(maps), metrics)]
    order = F.col("metric").desc() if evaluator.isLargerBetter() else F.col("metric").asc()
    return df.sparkSession.createDataFrame(rows, "params string, metric double").orderBy(order, "params")


def with_folds(df: DataFrame, label: str, key: str, k: int, seed: int = 3) -> DataFrame:
    """Stratified folds by hashed key."""
    h = hash_bucket([(F.col(key), 7919)], seed, 1_000_003)
    return stratified_folds(df, label, key, h, k, 1_000_003)


def predictions(model: Model, df: DataFrame, key: str) -> DataFrame:
    """``key, prediction`` and one probability column per class: p0, p1, ..."""
    out = model.transform(df).withColumn("__p", vector_to_array("probability"))
    classes = model.stages[-1].numClasses if isinstance(model, PipelineModel) else model.numClasses
    return out.select(key, "prediction", *[F.get("__p", i).alias(f"p{i}") for i in range(classes)])


def score_targets(train: DataFrame, test: DataFrame, key: str, targets: Sequence[str], estimator: Estimator) -> DataFrame:
    """One model of the same family per target over shared features; one probability column per target.

    The models add their column to the same frame one after another, so no result tables are joined.
    """
    scored = test.select(key, "features")
    with cached(train):
        for t in targets:
            e = estimator.copy()
            e.setLabelCol(t).setPredictionCol(f"__y_{t}").setProbabilityCol(f"__p_{t}").setRawPredictionCol(f"__r_{t}")
            rows = train.filter(F.col(t).isNotNull()).withColumn(t, F.col(t).cast("double"))
            scored = e.fit(rows).transform(scored)
    return scored.select(key, *[F.get(vector_to_array(f"__p_{t}"), 1).alias(t) for t in targets])


def default_candidates(inputs: int, label: str) -> dict[str, Estimator]:
    return {
        "logistic": elastic_logistic(label, 0.01),
        "bayes": gaussian_bayes(label),
        "forest": random_forest(label, numTrees=10, maxDepth=5, seed=1),
        "boosted": boosted_trees(label, trees=10, depth=3, rate=0.1, columns="all"),
        "network": feed_forward(inputs, [10, 10], 2, label, epochs=30),
    }


def auto_select(df: DataFrame, label: str, key: str, inputs: int, folds: int = 10, candidates: dict[str, Estimator] | None = None):
    """Candidate families over the same folds → (best model fitted on all rows, leaderboard)."""
    candidates = candidates or default_candidates(inputs, label)
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    folded = stage(with_folds(df, label, key, folds), "folds")
    rows = []
    with cached(folded):
        for name, est in candidates.items():
            scores = []
            for i in range(folds):
                model = est.fit(folded.filter(F.col("fold") != i))
                scores.append(auc.evaluate(model.transform(folded.filter(F.col("fold") == i))))
            rows.append((name, float(np.mean(scores))))
    board = df.sparkSession.createDataFrame(rows, "model string, auc double").orderBy(F.col("auc").desc(), "model")
    best = max(rows, key=lambda r: r[1])[0]
    return candidates[best].fit(df), board


def accuracy(model: Model, df: DataFrame, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(model.transform(df))


def importances(spark, model, names: Sequence[str], top: int | None = None) -> DataFrame:
    """Feature names with their importance, largest first."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(n, float(v)) for n, v in zip(names, tree.featureImportances.toArray())]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), F.col("feature").desc())
    return out.limit(top) if top else out


def describe_model(spark, model) -> DataFrame:
    """Parameters and, for trees, the rules as text: ``name, value``."""
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(p.name, str(v)) for p, v in stage.extractParamMap().items()]
    if hasattr(stage, "toDebugString"):
        rows.append(("rules", stage.toDebugString))
    return spark.createDataFrame(rows, "name string, value string").orderBy("name")
