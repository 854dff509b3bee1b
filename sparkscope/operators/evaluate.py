"""Confusion counts and class metrics.

The predictions are counted once per (actual, predicted) pair; everything after
that works on at most classes x classes rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.functions.columns import ratio
from sparkscope.runtime import equal_keys


def confusion_counts(predictions: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Non-empty cells: ``by..., actual, predicted, n``."""
    return predictions.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """All cells of observed predictions x observed actuals, zeros included.

    The distinct predicted labels of a group meet its distinct actual labels, row by
    row; a group's grid is never one row. Null labels have cells like any other.
    """
    counts = confusion_counts(predictions, actual, predicted, by)
    group = F.struct(*[F.col(name) for name in by]) if by else F.lit(0)
    cells = counts.withColumn("__group", group)
    grid = equal_keys(cells.select("__group", "predicted").distinct(), cells.select("__group", "actual").distinct(), ["__group"])
    filled = equal_keys(grid, cells.select("__group", "predicted", "actual", "n"), ["__group", "predicted", "actual"], "left")
    return filled.select(
        *[F.col(f"__group.{name}").alias(name) for name in by], "predicted", "actual", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of every class that occurs among the actuals.

    A class that is never predicted scores zero. ``counts`` is the result of
    ``confusion_counts`` or ``confusion_matrix``.
    """
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)

    def view(label: str, actual_n: Column, predicted_n: Column, tp: Column) -> Column:
        return F.struct(F.col(label).alias("class"), actual_n.alias("actual_n"),
                        predicted_n.alias("predicted_n"), tp.alias("tp"))

    sides = counts.select(*by, F.inline(F.array(
        view("actual", n, zero, hit), view("predicted", zero, n, zero))))
    totals = sides.groupBy(*by, "class").agg(
        F.sum("actual_n").alias("actual_n"), F.sum("predicted_n").alias("predicted_n"), F.sum("tp").alias("tp"))
    present = totals.filter(F.col("actual_n") > 0)
    precision = F.coalesce(ratio("tp", "predicted_n"), F.lit(0.0))
    recall = F.coalesce(ratio("tp", "actual_n"), F.lit(0.0))
    scored = present.withColumns({"precision": precision, "recall": recall})
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select(*by, "class", "precision", "recall", F.coalesce(f1, F.lit(0.0)).alias("f1"),
                         "tp", "actual_n", "predicted_n")


def macro_metrics(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and unweighted class means, from ``class_metrics``."""
    return per_class.groupBy(*by).agg(
        ratio(F.sum("tp"), F.sum("actual_n")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
    )


def fold_accuracy(predictions: DataFrame, actual: str, predicted: str, by: Sequence[str]) -> DataFrame:
    """Share of correct predictions per fold (and whatever else is in ``by``)."""
    correct = (F.col(actual) == F.col(predicted)).cast("double")
    return predictions.groupBy(*by).agg(F.avg(correct).alias("accuracy"))
