"""Invariants of the model studies."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import functions as F

from sparkscope.operators import models
from sparkscope.plans import classification, clustering
from sparkscope.plans.adapters import part_peaks
from sparkscope.plans.prepare import EXTENDED_PREDICTORS, PREDICTORS
from sparkscope.sources import results

SF = "/root/testdata/sf0.01"
TARGET = "category_name"


@pytest.fixture(scope="module")
def data(spark):
    return classification.modelling_table(part_peaks(spark, SF), "video_id", TARGET)


@pytest.fixture(scope="module")
def separable(spark):
    """Three classes that a line can separate."""
    rows = spark.range(600).select(
        F.col("id").alias("video_id"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias(TARGET),
        *[((F.col("id") % 3) * 10 * (i + 1) % 30 + F.col("id") % 7 / 10).alias(p) for i, p in enumerate(PREDICTORS)])
    return classification.modelling_table(rows, "video_id", TARGET)


@pytest.mark.parametrize("scenarios", [
    models.LOGISTIC_SCENARIOS[:2], models.SVM_SCENARIOS[:1],
    (models.ForestScenario("small", 5, 3, 1, 16), models.ForestScenario("smaller", 3, 2, 1, 16)),
])
def test_study(spark, separable, scenarios):
    study = classification.run_study(separable, TARGET, scenarios)
    n_test = separable.filter("part = 'test'").count()
    counts = {r.scenario: r["count"] for r in study.predictions.groupBy("scenario").count().collect()}
    assert counts == {s.name: n_test for s in scenarios}
    labels = {r.predicted_label for r in study.predictions.select("predicted_label").distinct().collect()}
    assert labels <= {"a", "b", "c"}
    folds = study.fold_accuracies.collect()
    assert {(r.scenario, r.fold) for r in folds} == {(s.name, i) for s in scenarios for i in range(3)}
    comparison = study.comparison.orderBy("ordinal").collect()
    assert [r.scenario for r in comparison] == [s.name for s in scenarios]
    assert comparison[0].accuracy > 0.9 and comparison[0].cv_accuracy > 0.9
    correct = study.predictions.filter(F.col(TARGET) == F.col("predicted_label"))
    assert comparison[0].accuracy == pytest.approx(
        correct.filter(F.col("scenario") == scenarios[0].name).count() / n_test, abs=1e-4)
    assert study.best().count() == 1
    assert "BatchEvalPython" not in study.predictions._jdf.queryExecution().executedPlan().toString()


def test_saved_studies_compare_like_the_originals(spark, separable, tmp_path):
    scenarios = {"logistic": models.LOGISTIC_SCENARIOS[:2], "forest": (models.ForestScenario("f", 3, 2, 1, 16),)}
    studies = {k: classification.run_study(separable, TARGET, v) for k, v in scenarios.items()}
    folders = {k: str(tmp_path / k) for k in studies}
    for k, study in studies.items():
        classification.save_study(study, folders[k])
    comparison, per_class = classification.compare_saved(spark, folders)
    direct = classification.compare_algorithms({k: s.best() for k, s in studies.items()})
    assert sorted(map(str, comparison.collect())) == sorted(map(str, direct.collect()))
    assert {(r.algorithm, r["class"]) for r in per_class.collect()} == {(a, c) for a in scenarios for c in "abc"}
    reloaded = models.predict(results.load_model(folders["forest"] + "/model"), separable.filter("part = 'test'"), TARGET)
    assert reloaded.count() == results.load_results(spark, folders["forest"], ["predictions"])["predictions"].count()


def test_modelling_table_parts_and_folds(spark, data):
    rows = data.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("fold").alias("folds")).collect()
    share = {r.part: r.n / data.count() for r in rows}
    assert share["training"] == pytest.approx(0.8, abs=0.03)
    assert {r.folds for r in rows} == {3}
    again = classification.modelling_table(part_peaks(spark, SF).repartition(5), "video_id", TARGET)
    assert data.exceptAll(again).count() == 0


def test_one_vs_rest_margins_match_the_model(data):
    index = models.fit_label_index(data, TARGET)
    scenario = models.SVM_SCENARIOS[0]
    model = models.classifier_pipeline(scenario, PREDICTORS, index).fit(data)
    ours = models.predict(model, data, TARGET, ["video_id"]).select("video_id", "prediction")
    builtin = model.transform(data).select("video_id", "prediction")
    assert ours.count() == data.count()
    assert ours.exceptAll(builtin).count() == 0


def test_forest_importance_and_saved_model(spark, data, tmp_path):
    index = models.fit_label_index(data, TARGET)
    model = models.classifier_pipeline(models.ForestScenario("f", 10, 4, 1, 32), PREDICTORS, index).fit(data)
    importance = models.feature_importance(spark, model, PREDICTORS).collect()
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)
    assert [name for _, name in models.stage_summary(model)] == [
        "StringIndexerModel", "VectorAssembler", "RandomForestClassificationModel"]
    results.save_model(model, str(tmp_path / "model"))
    loaded = results.load_model(str(tmp_path / "model"))
    before, after = (models.predict(m, data, TARGET, ["video_id"]) for m in (model, loaded))
    assert isinstance(loaded, PipelineModel) and before.exceptAll(after).count() == 0


def test_logistic_is_scaled_and_forest_is_not(data):
    index = models.fit_label_index(data, TARGET)
    stages = lambda s: [type(x).__name__ for x in models.classifier_pipeline(s, PREDICTORS, index).getStages()]
    assert "StandardScaler" in stages(models.LOGISTIC_SCENARIOS[0])
    assert "StandardScaler" in stages(models.SVM_SCENARIOS[0])
    assert "StandardScaler" not in stages(models.FOREST_SCENARIOS[0])


def test_compare_algorithms(spark):
    schema = ("ordinal int, scenario string, accuracy double, macro_f1 double, macro_precision double, "
              "macro_recall double, cv_accuracy double")
    one = spark.createDataFrame([(2, "s2", 0.3, 0.2, 0.2, 0.2, 0.3111)], schema)
    two = spark.createDataFrame([(1, "s1", 0.4, 0.1, 0.2, 0.2, 0.39)], schema)
    rows = {r.algorithm: r for r in classification.compare_algorithms({"A": one, "B": two}).collect()}
    assert rows["A"].generalization == 0.0111 and rows["B"].generalization == -0.01


def test_scaled_features(spark):
    peaks = part_peaks(spark, SF)
    values = vector_to_array("features")
    standard = clustering.scaled_features(peaks, PREDICTORS).select(values[0].alias("x"))
    r = standard.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert (r[0], r[1]) == pytest.approx((0.0, 1.0), abs=1e-9)
    minmax = clustering.scaled_features(peaks, PREDICTORS, minmax=True).select(values[0].alias("x"))
    assert tuple(minmax.agg(F.min("x"), F.max("x")).first()) == (0.0, 1.0)


def test_clusters_and_cost(spark):
    peaks = part_peaks(spark, SF)
    data = clustering.cluster_input(peaks, "video_id", PREDICTORS)
    scaled = clustering.scaled_features(data, PREDICTORS, data.columns)
    model = clustering.fit_kmeans(scaled, 4)
    assigned = model.transform(scaled)
    centers = F.array(*[F.array(*map(F.lit, map(float, c))) for c in model.clusterCenters()])
    gaps = F.zip_with(vector_to_array("features"), centers[F.col("prediction")], lambda a, b: (a - b) * (a - b))
    cost = assigned.select(F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x).alias("d")).agg(F.sum("d")).first()[0]
    assert model.summary.trainingCost == pytest.approx(cost)
    sizes = clustering.cluster_sizes(assigned).collect()
    assert sum(r.n for r in sizes) == data.count() and len(sizes) == 4


def test_clusters_do_not_depend_on_layout(spark):
    peaks = part_peaks(spark, SF)
    first = clustering.assign_clusters(peaks.repartition(3), "video_id", PREDICTORS, 4)
    second = clustering.assign_clusters(peaks.repartition(11), "video_id", PREDICTORS, 4)
    columns = ["video_id", "prediction"]
    assert first.select(columns).exceptAll(second.select(columns)).count() == 0


def test_sweep(spark):
    assignments, summary = clustering.cluster_sweep(part_peaks(spark, SF), "video_id")
    rows = summary.collect()
    assert [r.key for r in rows] == ["basic_k4", "extended_k4", "basic_k6", "extended_k6"] == [
        s.key for s in clustering.CLUSTER_SCENARIOS]
    assert all(r.wcss > 0 for r in rows)
    assert {len(clustering.cluster_sizes(a).collect()) for key, a in assignments.items() if key.endswith("k4")} == {4}
    assert set(EXTENDED_PREDICTORS) <= set(assignments["extended_k4"].columns)


def test_heatmap_of_a_constant_feature_is_zero(spark):
    profile = spark.createDataFrame([(0, 1.0, 5.0), (1, 3.0, 5.0), (2, 2.0, 5.0)], "prediction int, a double, b double")
    cells = {(r.prediction, r.feature): r.value for r in clustering.cluster_heatmap(profile, ["a", "b"]).collect()}
    assert cells == {(0, "a"): 0.0, (1, "a"): 1.0, (2, "a"): 0.5, (0, "b"): 0.0, (1, "b"): 0.0, (2, "b"): 0.0}
    wide = {r.prediction: (r.a, r.b) for r in clustering.cluster_profile_scaled(profile, ["a", "b"]).collect()}
    assert wide == {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (0.5, 0.0)}
