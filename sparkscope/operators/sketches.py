"""Stored summaries that merge without reading the rows again.

A summary table has one row per column and group (say, day or file): exact count, mean,
variance, least and greatest value, and a KLL quantile sketch as a binary column. Summaries
of parts are merged into summaries of any coarser grouping, so a description of a month or
of everything costs its days' summary rows, not its data. Distinct counts work alike, with
HyperLogLog sketches. All of it is Spark's own aggregation, with partial sketches in every
task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.operators.quantiles import long_values

# Size of a quantile sketch; its rank error falls almost in proportion.
KLL_K = 1024
# log2 of a distinct sketch's registers: a relative error of about 1.6 %.
HLL_LOG2 = 12


def kll_rank_error(k: int = KLL_K) -> float:
    """Published rank error, as a share of the rows, that a KLL sketch keeps to with 99 % confidence (two-sided)."""
    return 2.446 / k ** 0.9433


def summaries(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """``by..., column, n, mean, m2, min, max, sketch`` of the values that are neither null nor NaN.

    ``m2`` is the sum of squared distances from the mean. A column without values in a group has no row.
    """
    value = F.col("value")
    numbers = long_values(df, columns, by).filter(value.isNotNull() & ~F.isnan(value))
    return numbers.groupBy(*by, "column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.kll_sketch_agg_double("value", k).alias("sketch"))


def merge_summaries(parts: DataFrame, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """Summaries of a coarser grouping; ``by`` are columns of ``parts`` (or expressions named before)."""
    n, mean = F.col("n"), F.col("mean")
    total = parts.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), (F.sum(n * mean) / F.sum("n")).alias("mean"), F.sum("m2").alias("within"),
        F.sum(n * mean * mean).alias("around_zero"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))
    between = F.greatest(F.col("around_zero") - n * mean * mean, F.lit(0.0))
    return total.select(*by, "column", "n", "mean", (F.col("within") + between).alias("m2"), "min", "max", "sketch")


def summary_quantiles(parts: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, p, value`` of every summary row."""
    grid = F.array(*[F.lit(float(p)) for p in probs])
    pairs = F.arrays_zip(grid.alias("p"), F.kll_sketch_get_quantile_double("sketch", grid).alias("value"))
    return parts.select(*by, "column", F.explode(pairs).alias("q")).select(*by, "column", "q.p", "q.value")


def summary_ranks(parts: DataFrame, values: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, value, share``: the share of values up to each given one."""
    grid = F.array(*[F.lit(float(v)) for v in values])
    pairs = F.arrays_zip(grid.alias("value"), F.kll_sketch_get_rank_double("sketch", grid).alias("share"))
    return parts.select(*by, "column", F.explode(pairs).alias("r")).select(*by, "column", "r.value", "r.share")


def describe_summaries(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns of ``describe_numeric`` and ``n``, from stored summaries."""
    def at(p: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(p))

    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return parts.select(*by, "column", "n", "mean", at(0.5).alias("median"), spread.alias("sd"), "min", "max",
                        at(0.25).alias("q1"), at(0.75).alias("q3"))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), log2_size: int = HLL_LOG2) -> DataFrame:
    """``by..., column, sketch``: one distinct-count sketch per column and group; nulls do not count."""
    wide = df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), log2_size).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column", "sketch")


def merge_distinct(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return parts.groupBy(*by, "column").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, n_distinct``."""
    return parts.select(*by, "column", F.hll_sketch_estimate("sketch").alias("n_distinct"))
