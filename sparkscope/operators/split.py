"""Samples, train/test splits and folds.

The hash forms are fixed by a unique key, so they do not change with the
partitioning, need no shuffle and repeat exactly when a task is retried. The
random forms are Spark's own; ``random_split`` first puts the rows into a fixed
layout, because seeded sampling depends on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.functions.columns import hash_unit


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    return df.filter(hash_unit(key, f"{seed}:sample") < fraction)


def hash_split(key: str | Column, weights: Mapping[str, float], seed: int = 42) -> Column:
    """Name of the part each row falls in, with the given relative weights."""
    total = sum(weights.values())
    unit = hash_unit(key, f"{seed}:split")
    names = list(weights)
    edge = 0.0
    part = None
    for name in names[:-1]:
        edge += weights[name] / total
        part = F.when(unit < edge, name) if part is None else part.when(unit < edge, name)
    return F.lit(names[0]) if part is None else part.otherwise(names[-1])


def fold_number(key: str | Column, k: int = 3, seed: int = 42) -> Column:
    """Cross-validation fold 0..k-1, independent of ``hash_split``."""
    return F.floor(hash_unit(key, f"{seed}:fold") * k).cast("int")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(False, fraction, seed)


def random_split(df: DataFrame, key: str, weights: Sequence[float], partitions: int,
                 seed: int = 42) -> list[DataFrame]:
    """Seeded random parts that do not depend on how ``df`` was partitioned."""
    laid_out = df.repartition(partitions, key).sortWithinPartitions(key)
    return laid_out.randomSplit(list(weights), seed)
