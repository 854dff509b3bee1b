"""Filters, keyed dedup, missing-value audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.functions.columns import is_missing, percent, shown
from sparkscope.runtime import all_of, join_summary


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every named column has a value."""
    return df.filter(all_of([F.col(name).isNotNull() for name in columns]))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows usable for modelling: no null and no NaN in the named columns."""
    return df.dropna(subset=list(columns))


def fill_text(df: DataFrame, columns: Sequence[str], value: str = "") -> DataFrame:
    return df.fillna(value, subset=list(columns))


def dedup_keyed(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key combination: the first in the given order, all columns kept.

    ``order`` should be total over the columns that matter, so that the kept row
    does not depend on partitioning. Filtering on the first row number lets Spark
    cut each key to one row per task before the shuffle, so a key with very many
    copies costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(window)).filter("__row = 1").drop("__row")


def missing_audit(df: DataFrame, zero_is_missing: Mapping[str, bool]) -> DataFrame:
    """One row with ``<column>_na``: missing values (null, NaN) of each column, in one pass."""
    return df.agg(*[
        F.count_if(is_missing(shown(df, name), zero)).alias(f"{name}_na")
        for name, zero in zero_is_missing.items()
    ])


def missing_ratio(df: DataFrame, name: str, zero_is_missing: bool = False) -> DataFrame:
    """Total, present and missing counts of one column, and the missing percentage."""
    missing = is_missing(shown(df, name), zero_is_missing)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~missing).alias(f"{name}_present"),
        F.count_if(missing).alias(f"{name}_missing"),
    )
    return counts.withColumn("missing_percentage", percent(f"{name}_missing", "total"))


def frequent_classes(df: DataFrame, name: str, min_samples: int = 50) -> DataFrame:
    """Rows whose class occurs at least ``min_samples`` times.

    The class counts are pre-aggregated before their shuffle and joined back
    through ``join_summary``, which keeps the rows themselves unshuffled.
    """
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col(name).isNotNull() & (F.col("n") >= min_samples)).select(name)
    return join_summary(df, frequent, [name], "left_semi")


def frequent_among_many(df: DataFrame, name: str, min_samples: int = 50, buckets: int = 1 << 20) -> DataFrame:
    """The rows of ``frequent_classes``, for a column of very many classes.

    A first pass counts rows per hash bucket, so at most ``buckets`` counters a task are
    shuffled. A class in a bucket of fewer rows is surely rare, so the exact counts are only
    shuffled for classes in the other buckets, and no frequent class is ever lost. The
    buckets that remain are at most rows / ``min_samples`` or ``buckets``, whichever is less.
    """
    bucket = F.pmod(F.xxhash64(F.col(name)), F.lit(buckets)).cast("int")
    full = df.filter(F.col(name).isNotNull()).groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("n"))
    hashed = df.withColumn("__bucket", bucket)
    likely = join_summary(hashed, full.filter(F.col("n") >= min_samples).select("__bucket"), ["__bucket"], "left_semi")
    return frequent_classes(likely.drop("__bucket"), name, min_samples)
