"""K-means studies: elbow, scenario sweep, cluster sizes and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkscope.functions.columns import ratio
from sparkscope.operators.clean import complete_cases
from sparkscope.operators.models import assembler, minmax_scaler, standard_scaler
from sparkscope.operators.reshape import melt, stack_tagged
from sparkscope.operators.rollup import group_counts, group_means
from sparkscope.operators.split import hash_sample
from sparkscope.plans.prepare import EXTENDED_PREDICTORS, PREDICTORS
from sparkscope.runtime import in_parallel, materialize, persisted
from sparkscope.sources.results import load_results, save_results


Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


@dataclass(frozen=True)
class ClusterScenario:
    name: str
    k: int
    feature_set: str

    @property
    def key(self) -> str:
        return f"{self.feature_set}_k{self.k}"


FEATURE_SETS = {"basic": PREDICTORS, "extended": EXTENDED_PREDICTORS}
# The settings compared, and the range of k of the elbow curve.
CLUSTER_SCENARIOS = (
    ClusterScenario("Scenario A: k=4, basic features", 4, "basic"),
    ClusterScenario("Scenario B: k=4, extended features", 4, "extended"),
    ClusterScenario("Scenario C: k=6, basic features", 6, "basic"),
    ClusterScenario("Scenario D: k=6, extended features", 6, "extended"),
)
ELBOW_K = tuple(range(2, 11))
# Tasks of a fit: fixed, so that seeding does not depend on the number of rows. Raise it with the cluster.
FIT_TASKS = 32
SUMMARY_SCHEMA = "key string, scenario string, k int, feature_set string, wcss double"


def scaled_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                    minmax: bool = False) -> DataFrame:
    """Complete rows with a scaled ``features`` vector; the scaler is fitted here."""
    usable = complete_cases(df, features).select(*dict.fromkeys([*keep, *features]))
    scaler = minmax_scaler() if minmax else standard_scaler()
    return Pipeline(stages=[assembler(features), scaler]).fit(usable).transform(usable).drop("features_raw")


def cluster_input(df: DataFrame, key: Key, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows with the key and the features, written once for the passes of a study."""
    columns = dict.fromkeys([*key_columns(key), *features, *keep])
    return materialize(complete_cases(df, features).select(*columns), "clustering")


def fixed_layout(df: DataFrame, key: Key, tasks: int = FIT_TASKS) -> DataFrame:
    """The same rows in the same tasks in the same order, whatever the input layout.

    K-means seeding samples per partition, so without this a seed fixes nothing.
    ``key`` (one column or several) should be unique, which also spreads the rows evenly.
    """
    return df.repartition(tasks, *key_columns(key)).sortWithinPartitions(*key_columns(key))


def fit_kmeans(scaled: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    return KMeans(featuresCol="features", predictionCol="prediction", k=k, seed=seed, maxIter=100,
                  initSteps=5).fit(scaled)


def assign_clusters(df: DataFrame, key: Key, features: Sequence[str], k: int, seed: int = 42,
                    keep: Sequence[str] = (), tasks: int = FIT_TASKS) -> DataFrame:
    """``key, features..., keep..., prediction``, clustered on standardised features.

    Only the fit needs the fixed layout; assigning works on the rows where they are.
    """
    data = cluster_input(df, key, features, keep)
    scaled = scaled_features(data, features, data.columns)
    with persisted(fixed_layout(scaled, key, tasks)) as held:
        model = fit_kmeans(held, k, seed)
    return model.transform(scaled).drop("features")


def elbow(df: DataFrame, key: Key, features: Sequence[str] = PREDICTORS, ks: Sequence[int] = ELBOW_K,
          seed: int = 42, tasks: int = FIT_TASKS) -> DataFrame:
    """``k, wcss``. The features are scaled once for all k."""
    data = cluster_input(df, key, features)
    with persisted(fixed_layout(scaled_features(data, features, data.columns), key, tasks)) as held:
        def cost(k: int) -> float:
            return float(fit_kmeans(held, k, seed).summary.trainingCost)

        rows = list(zip(ks, in_parallel(df.sparkSession, cost, ks)))
    return df.sparkSession.createDataFrame(rows, "k int, wcss double")


def cluster_sweep(df: DataFrame, key: Key, scenarios: Sequence[ClusterScenario] = CLUSTER_SCENARIOS,
                  seed: int = 42, tasks: int = FIT_TASKS) -> tuple[dict[str, DataFrame], DataFrame]:
    """Assignments per scenario key, and the rounded WCSS table.

    Costs of different feature sets are not comparable: more features, more variance.
    """
    assignments: dict[str, DataFrame] = {}
    costs: dict[str, float] = {}
    sets = dict.fromkeys(s.feature_set for s in scenarios)
    data = cluster_input(df, key, list(dict.fromkeys(f for name in sets for f in FEATURE_SETS[name])))
    for feature_set in sets:
        chosen = [s for s in scenarios if s.feature_set == feature_set]
        scaled = scaled_features(data, FEATURE_SETS[feature_set], data.columns)
        with persisted(fixed_layout(scaled, key, tasks)) as held:
            fitted = in_parallel(df.sparkSession, lambda s: fit_kmeans(held, s.k, seed), chosen)
        for scenario, model in zip(chosen, fitted):
            costs[scenario.key] = float(model.summary.trainingCost)
            assignments[scenario.key] = model.transform(scaled).drop("features")
    rows = [(s.key, s.name, s.k, s.feature_set, costs[s.key]) for s in scenarios]
    summary = df.sparkSession.createDataFrame(rows, SUMMARY_SCHEMA).withColumn("wcss", F.round("wcss", 2))
    return assignments, summary


def cluster_overview(assignments: Mapping[str, DataFrame], features: Sequence[str] = EXTENDED_PREDICTORS,
                     cluster: str = "prediction") -> DataFrame:
    """``key, cluster, n, means...``: size and feature means of every cluster of every scenario.

    A feature that a scenario does not have is null in its rows.
    """
    def one(assigned: DataFrame) -> DataFrame:
        own = [name for name in features if name in assigned.columns]
        return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(name).alias(name) for name in own])

    return stack_tagged({key: one(assigned) for key, assigned in assignments.items()}, "key")


def save_clusters(folder: str, curve: DataFrame, summary: DataFrame, assignments: Mapping[str, DataFrame]) -> None:
    """Keep a clustering study: elbow curve, WCSS summary, sizes and means of all scenarios."""
    save_results({"elbow": curve, "summary": summary, "overview": cluster_overview(assignments)}, folder)


def load_clusters(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return load_results(spark, folder, ["elbow", "summary", "overview"])


def cluster_sizes(assigned: DataFrame, cluster: str = "prediction") -> DataFrame:
    return group_counts(assigned, [cluster]).orderBy(cluster)


def cluster_profile(assigned: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Means of the original features per cluster."""
    return group_means(assigned, [cluster], features).orderBy(cluster)


def cluster_heatmap(profile: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """``cluster, feature, value``: each feature scaled to [0, 1] over the clusters.

    A feature that is the same in all clusters becomes zero. ``profile`` holds one
    row per cluster.
    """
    rows = melt(profile, [cluster], features, "feature", "value")
    feature = Window.partitionBy("feature")
    low, high = F.min("value").over(feature), F.max("value").over(feature)
    return rows.withColumn("value", F.coalesce(ratio(F.col("value") - low, high - low), F.lit(0.0)))


def cluster_profile_scaled(profile: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """The heatmap in wide form: one column per feature."""
    heatmap = cluster_heatmap(profile, features, cluster)
    return heatmap.groupBy(cluster).pivot("feature", list(features)).agg(F.first("value"))


def cluster_sample(assigned: DataFrame, key: str, x: str, y: str, fraction: float = 0.05, seed: int = 42,
                   cluster: str = "prediction") -> DataFrame:
    """A reproducible sample of points for a two-dimensional cluster view."""
    return hash_sample(assigned, key, fraction, seed).select(key, x, y, cluster)
