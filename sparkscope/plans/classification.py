"""Classification studies: cross-validate, fit, test and compare named scenarios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscope.functions.columns import round_columns, string_key
from sparkscope.operators.clean import complete_cases, frequent_classes
from sparkscope.operators.evaluate import class_metrics, confusion_counts, fold_accuracy, macro_metrics
from sparkscope.operators.models import Scenario, classifier_pipeline, fit_label_index, predict
from sparkscope.operators.reshape import best_row, stack, stack_tagged
from sparkscope.operators.split import fold_number, hash_split
from sparkscope.plans.prepare import PREDICTORS
from sparkscope.runtime import in_parallel, materialize, persisted, shared_dir
from sparkscope.sources.results import load_results, save_model, save_results

METRICS = ("accuracy", "macro_f1", "macro_precision", "macro_recall")
# Share of the rows used for training and for testing.
SPLIT = {"training": 0.8, "test": 0.2}


def modelling_table(df: DataFrame, key: str | Sequence[str], target: str, predictors: Sequence[str] = PREDICTORS,
                    min_samples: int = 50, folds: int = 3, seed: int = 42) -> DataFrame:
    """Rows fit for modelling with their ``part`` and ``fold``.

    Classes with few samples and incomplete rows are dropped, then the narrow table is
    written by part and fold, so that what follows reads only the files it needs.
    ``key`` (one column or several, together unique) alone decides part and fold, so
    a rerun splits identically.
    """
    keys = [key] if isinstance(key, str) else list(key)
    unit = keys[0] if len(keys) == 1 else string_key(*keys, sep="|")
    narrow = df.select(*keys, target, *predictors).withColumns({
        "part": hash_split(unit, SPLIT, seed), "fold": fold_number(unit, folds, seed)})
    usable = complete_cases(frequent_classes(narrow, target, min_samples), [target, *predictors])
    return materialize(usable, "modelling", ["part", "fold"])


@dataclass(frozen=True)
class ClassificationStudy:
    """Fitted models and lazy result tables of one algorithm's scenarios."""

    models: Mapping[str, PipelineModel]
    predictions: DataFrame        # scenario, target, prediction, predicted_label on the test part
    validated: DataFrame          # scenario, fold, target, prediction, predicted_label on the fold left out
    fold_accuracies: DataFrame    # scenario, fold, accuracy
    per_class: DataFrame          # scenario, class, precision, recall, f1, ...
    comparison: DataFrame         # scenario, ordinal, metrics and cv_accuracy rounded to 4 digits

    def best(self) -> DataFrame:
        """Best scenario by rounded macro F1; the first listed wins ties."""
        return best_row(self.comparison, "macro_f1", "ordinal")


def scenario_comparison(per_class: DataFrame, fold_accuracies: DataFrame, ordinals: DataFrame) -> DataFrame:
    """One rounded row per scenario; all inputs are already per-class summaries."""
    cv = fold_accuracies.groupBy("scenario").agg(F.avg("accuracy").alias("cv_accuracy"))
    rows = macro_metrics(per_class, ["scenario"]).join(cv, "scenario").join(ordinals, "scenario")
    return round_columns(rows, [*METRICS, "cv_accuracy"], 4).select("ordinal", "scenario", *METRICS, "cv_accuracy")


def run_study(data: DataFrame, target: str, scenarios: Sequence[Scenario],
              predictors: Sequence[str] = PREDICTORS, folds: int = 3, parallelism: int = 4) -> ClassificationStudy:
    """Fit every scenario on each fold's complement and on the whole training part.

    ``data`` comes from ``modelling_table``. Only the fits are actions; the
    training rows stay in memory and on disk while they run, a few fits at a
    time. Predictions and metrics are lazy queries over the written table. The
    class index is fitted once, so a fold can hold no unknown class, and the
    scaler is refitted per fold, so no validation row influences it.
    """
    spark = data.sparkSession
    if any(getattr(s, "cache_nodes", False) for s in scenarios) and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    train, test = data.filter("part = 'training'"), data.filter("part = 'test'")
    index = fit_label_index(data, target)
    jobs = [(scenario, fold) for scenario in scenarios for fold in [*range(folds), None]]

    with persisted(train) as held:
        def fit(job):
            scenario, fold = job
            rows = held if fold is None else held.filter(F.col("fold") != fold)
            return classifier_pipeline(scenario, predictors, index).fit(rows)

        fitted = dict(zip(jobs, in_parallel(spark, fit, jobs, parallelism)))

    tested = stack_tagged(
        {s.name: predict(fitted[s, None], test, target) for s in scenarios}, "scenario")
    validated = stack([
        predict(model, train.filter(F.col("fold") == fold), target, ["fold"])
        .withColumn("scenario", F.lit(scenario.name))
        for (scenario, fold), model in fitted.items() if fold is not None
    ])
    accuracies = fold_accuracy(validated, target, "predicted_label", ["scenario", "fold"])
    per_class = class_metrics(confusion_counts(tested, target, "predicted_label", ["scenario"]), ["scenario"])
    ordinals = spark.createDataFrame(
        [(i, s.name) for i, s in enumerate(scenarios, 1)], "ordinal int, scenario string")
    return ClassificationStudy(
        models={s.name: fitted[s, None] for s in scenarios},
        predictions=tested, validated=validated, fold_accuracies=accuracies, per_class=per_class,
        comparison=scenario_comparison(per_class, accuracies, ordinals),
    )


def compare_algorithms(best_rows: Mapping[str, DataFrame]) -> DataFrame:
    """One row per algorithm with the gap between validation and test accuracy."""
    rows = stack_tagged({name: row.drop("ordinal") for name, row in best_rows.items()}, "algorithm")
    gap = F.round(F.col("cv_accuracy") - F.col("accuracy"), 4)
    return rows.select("algorithm", "scenario", *METRICS, "cv_accuracy", gap.alias("generalization"))


def overall_best(best_rows: Mapping[str, DataFrame]) -> DataFrame:
    """The best algorithm by rounded macro F1; the first listed wins ties."""
    rows = compare_algorithms(best_rows)
    order = F.array_position(F.array(*map(F.lit, best_rows)), F.col("algorithm"))
    return best_row(rows.withColumn("ordinal", order), "macro_f1", "ordinal").drop("ordinal")


def save_study(study: ClassificationStudy, folder: str) -> None:
    """Keep the best scenario: its comparison row, class metrics, predictions and model.

    The one comparison row is read first, to know which model to save.
    """
    best = materialize(study.best(), "best")
    name = best.first().scenario
    chosen = F.col("scenario") == name
    save_results({
        "comparison": best,
        "per_class": study.per_class.filter(chosen),
        "predictions": study.predictions.filter(chosen),
    }, folder)
    save_model(study.models[name], f"{folder}/model")


def best_saved(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """The best of saved studies, without refitting."""
    return overall_best({name: load_results(spark, folder, ["comparison"])["comparison"] for name, folder in folders.items()})


def compare_saved(spark: SparkSession, folders: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Algorithm comparison and class F1 by algorithm, from saved studies, without refitting."""
    saved = {name: load_results(spark, folder, ["comparison", "per_class"]) for name, folder in folders.items()}
    comparison = compare_algorithms({name: tables["comparison"] for name, tables in saved.items()})
    per_class = stack_tagged(
        {name: tables["per_class"].select("class", "f1") for name, tables in saved.items()}, "algorithm")
    return comparison, per_class
