"""Descriptive summary, correlation, redundancy screen."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.functions.columns import ratio
from sparkscope.operators.clean import complete_cases
from sparkscope.operators.quantiles import SKETCH_ACCURACY, quantiles
from sparkscope.operators.reshape import per_column


def describe_numeric(df: DataFrame, columns: Sequence[str], accuracy: int | None = SKETCH_ACCURACY) -> DataFrame:
    """One row per column: mean, median, sd, min, max, q1, q3 (discrete quantiles)."""
    moments = per_column(df, columns, {"mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max})
    spread = quantiles(df, columns, [0.25, 0.5, 0.75], accuracy=accuracy).groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"),
    )
    return moments.join(spread, "column")


def pearson(x: str, y: str) -> Column:
    """Correlation that is null, not an error, when a column is constant."""
    varied = [F.max(name) > F.min(name) for name in (x, y)]  # partial sums give a constant a tiny variance
    return F.when(varied[0] & varied[1], ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)))


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var1, var2, value`` for every ordered pair, over complete cases, in one pass."""
    pairs = list(combinations(columns, 2))
    wide = complete_cases(df, columns).agg(
        *[pearson(x, y).alias(f"r{i}") for i, (x, y) in enumerate(pairs)],
        *[pearson(x, x).alias(f"d{i}") for i, x in enumerate(columns)],
    )
    def cell(x: str, y: str, value: str) -> Column:
        return F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"), F.col(value).alias("value"))

    cells = [cell(x, x, f"d{i}") for i, x in enumerate(columns)]
    for i, (x, y) in enumerate(pairs):
        cells += [cell(x, y, f"r{i}"), cell(y, x, f"r{i}")]
    return wide.select(F.inline(F.array(*cells)))


def correlation_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``correlation_long`` for hundreds of columns.

    One vector-valued aggregate sums all products at once, in partial sums that are merged in
    a tree, where ``correlation_long`` needs an expression for every pair. Only the matrix, of
    the size of the result, reaches the driver. Columns are centred before their products are
    summed; a constant column, and all of fewer than two complete rows, correlate to null.
    """
    names = list(columns)
    rows = complete_cases(df.select(*[F.col(name).cast("double").alias(name) for name in names]), names)
    size, *each = rows.agg(F.count(F.lit(1)), *[F.struct(F.avg(name), F.max(name) > F.min(name)) for name in names]).first()
    varied = [bool(x[1]) for x in each]
    if size < 2:
        cells = [(x, y, None) for x in names for y in names]
    else:
        centred = rows.select(*[(F.col(name) - F.lit(x[0])).alias(name) for name, x in zip(names, each)])
        vectors = VectorAssembler(inputCols=names, outputCol="values").transform(centred).select("values")
        matrix = Correlation.corr(vectors, "values").first()[0].toArray()
        cells = [(x, y, float(matrix[i, j]) if varied[i] and varied[j] else None)
                 for i, x in enumerate(names) for j, y in enumerate(names)]
    return df.sparkSession.createDataFrame(cells, "var1 string, var2 string, value double")


def redundant_features(df: DataFrame, candidates: Sequence[str], kept: Sequence[str],
                       threshold: float = 0.95) -> DataFrame:
    """Candidate/kept pairs with their correlation and whether the candidate adds nothing."""
    names = list(dict.fromkeys([*kept, *candidates]))
    return correlation_long(df, names).filter(
        F.col("var1").isin(list(candidates)) & F.col("var2").isin(list(kept))
    ).select(
        F.col("var1").alias("candidate"), F.col("var2").alias("kept"), "value",
        F.coalesce(F.abs("value") >= threshold, F.lit(False)).alias("redundant"),
    )
