"""Dimension lookup, peak-per-entity rollup, engagement ratios, group summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.functions.columns import percent, ratio


def lookup(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left outer lookup; a key the dimension lacks gets nulls.

    A dimension given as literals carries its own broadcast hint (its size is known
    in the program). For a table Spark decides by its measured size and
    ``spark.sql.autoBroadcastJoinThreshold``; when it shuffles, adaptive execution
    splits hot keys.
    """
    return df.join(dimension, key, "left")


def peak_rollup(df: DataFrame, keys: Sequence[str], peaks: Sequence[str],
                count_name: str = "trending_count") -> DataFrame:
    """One row per entity: the maximum of each peak column and the number of rows.

    Maxima are taken per column, so they may stem from different snapshots.
    """
    return df.groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in peaks],
        F.count(F.lit(1)).alias(count_name),
    )


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str | Column, str]]) -> DataFrame:
    """Ratio columns ``name -> (numerator, denominator)``.

    Keeps only rows with a positive denominator and a value in every ratio.
    """
    df = df.withColumns({name: ratio(top, bottom) for name, (top, bottom) in ratios.items()})
    for name, (_, bottom) in ratios.items():
        df = df.filter((F.col(bottom) > 0) & F.col(name).isNotNull())
    return df


def group_counts(df: DataFrame, keys: Sequence[str], ordered: bool = False) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *keys) if ordered else counts


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(name).alias(name) for name in columns])


def class_balance(df: DataFrame, name: str) -> DataFrame:
    """Count and percentage share of each class, most frequent first.

    The total is a scalar subquery over the counts, so the rows are counted once
    per class and never brought into one window.
    """
    counts = group_counts(df, [name])
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", percent("n", total)).orderBy(F.desc("n"), name)
