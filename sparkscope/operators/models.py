"""Pipelines for the three classifiers.

Training is Spark ML's own distributed optimisation. Scenario defaults keep tree
depth and bin counts small, because a forest's statistics per level grow with
nodes x features x bins x classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import (
    IndexToString, MinMaxScaler, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LogisticScenario:
    name: str
    elastic_net: float
    reg_param: float
    max_iter: int = 30
    scaled = True

    def estimator(self):
        return LogisticRegression(family="multinomial", elasticNetParam=self.elastic_net,
                                  regParam=self.reg_param, maxIter=self.max_iter)


@dataclass(frozen=True)
class SvmScenario:
    name: str
    reg_param: float
    max_iter: int
    scaled = True

    def estimator(self):
        # One binary model after the other: scenarios and folds already run side by side,
        # and the threads of OneVsRest itself would share one set of local properties.
        return OneVsRest(classifier=LinearSVC(regParam=self.reg_param, maxIter=self.max_iter), parallelism=1)


@dataclass(frozen=True)
class ForestScenario:
    name: str
    num_trees: int
    max_depth: int
    min_instances: int
    max_bins: int
    seed: int = 42
    cache_nodes: bool = False
    checkpoint_every: int = 10
    memory_mb: int = 256
    scaled = False

    def estimator(self):
        """The forest; ``cache_nodes`` is for deep trees (see ``deep_forest``).

        Without it every task gets all trees grown so far and walks each row through them on
        every level. With it a row's node in every tree is kept beside the row, and written to
        the checkpoint folder every few levels so that lost executors cost no long lineage.
        ``memory_mb`` bounds the statistics of the nodes that one pass splits; more nodes than
        fit take more passes.
        """
        return RandomForestClassifier(numTrees=self.num_trees, maxDepth=self.max_depth,
                                      minInstancesPerNode=self.min_instances, maxBins=self.max_bins,
                                      seed=self.seed, cacheNodeIds=self.cache_nodes,
                                      checkpointInterval=self.checkpoint_every, maxMemoryInMB=self.memory_mb)


Scenario = LogisticScenario | SvmScenario | ForestScenario

def deep_forest(name: str, num_trees: int, max_depth: int, min_instances: int = 1, max_bins: int = 32,
                memory_mb: int = 256, checkpoint_every: int = 5) -> ForestScenario:
    """A scenario of deep trees that grows within a memory budget; same trees as without the cache."""
    return ForestScenario(name, num_trees, max_depth, min_instances, max_bins, cache_nodes=True,
                          checkpoint_every=checkpoint_every, memory_mb=memory_mb)


# The settings compared for each algorithm.
LOGISTIC_SCENARIOS = (
    LogisticScenario("Scenario 1: L2 (Ridge), lambda=0.001", 0.0, 0.001),
    LogisticScenario("Scenario 2: L2 (Ridge), lambda=0.1", 0.0, 0.1),
    LogisticScenario("Scenario 3: L1 (Lasso), lambda=0.01", 1.0, 0.01),
)
SVM_SCENARIOS = (
    SvmScenario("Scenario 1: reg=0.001, max_iter=5", 0.001, 5),
    SvmScenario("Scenario 2: reg=0.1, max_iter=5", 0.1, 5),
    SvmScenario("Scenario 3: reg=0.001, max_iter=10", 0.001, 10),
)
FOREST_SCENARIOS = (
    ForestScenario("Scenario 1: num_trees=50, max_depth=5, min_inst=1", 50, 5, 1, 32),
    ForestScenario("Scenario 2: num_trees=100, max_depth=5, min_inst=1", 100, 5, 1, 32),
    ForestScenario("Scenario 3: num_trees=50, max_depth=8, min_inst=5, max_bins=16", 50, 8, 5, 16),
)


def fit_label_index(df: DataFrame, target: str) -> StringIndexerModel:
    """Class -> index, most frequent first and ties by name."""
    return StringIndexer(inputCol=target, outputCol="label", stringOrderType="frequencyDesc").fit(df)


def assembler(predictors: Sequence[str], output: str = "features_raw") -> VectorAssembler:
    return VectorAssembler(inputCols=list(predictors), outputCol=output)


def standard_scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def minmax_scaler(source: str = "features_raw", output: str = "features") -> MinMaxScaler:
    return MinMaxScaler(inputCol=source, outputCol=output)


def classifier_pipeline(scenario: Scenario, predictors: Sequence[str],
                        label_index: Transformer | StringIndexer) -> Pipeline:
    """Index, assemble, scale where the model is sensitive to scale, classify."""
    if scenario.scaled:
        features = [assembler(predictors), standard_scaler()]
    else:
        features = [assembler(predictors, "features")]
    return Pipeline(stages=[label_index, *features, scenario.estimator()])


def strongest_class(model: OneVsRestModel, features: str = "features") -> Column:
    """Index of the binary model with the largest margin, the first one on ties.

    ``OneVsRestModel.transform`` gathers the margins in Python functions, row by
    row; the margins are linear, so plain column arithmetic gives the same.
    """
    values = vector_to_array(features)
    margins = F.array(*[
        reduce(add, [F.lit(float(w)) * values[i] for i, w in enumerate(binary.coefficients)])
        + F.lit(float(binary.intercept))
        for binary in model.models
    ])
    return (F.array_position(margins, F.array_max(margins)) - 1).cast("double")


def label_names(df: DataFrame, index: str, output: str, labels: Sequence[str]) -> DataFrame:
    """Add the class name of every index."""
    return IndexToString(inputCol=index, outputCol=output, labels=list(labels)).transform(df)


def predict(model: PipelineModel, df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., target, prediction, predicted_label``."""
    *features, classifier = model.stages
    if isinstance(classifier, OneVsRestModel):
        scored = PipelineModel(features).transform(df).withColumn("prediction", strongest_class(classifier))
    else:
        scored = model.transform(df)
    named = label_names(scored, "prediction", "predicted_label", model.stages[0].labels)
    return named.select(*keep, target, "prediction", "predicted_label")


def stage_summary(model: PipelineModel) -> list[tuple[int, str]]:
    return [(i, type(stage).__name__) for i, stage in enumerate(model.stages)]


def feature_importance(spark: SparkSession, model: PipelineModel, predictors: Sequence[str]) -> DataFrame:
    """``feature, importance``, most important first; one row per predictor."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(predictors, weights)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
