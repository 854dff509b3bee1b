"""Unpivot, stacking, top rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable",
         value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def per_column(df: DataFrame, columns: Sequence[str], aggregates: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """``column, <aggregates>``: the same aggregates of several columns, in one pass.

    They are computed side by side, without repeating rows per column, and only
    the one-row result is turned.
    """
    wide = df.agg(*[
        make(F.col(name).cast("double")).alias(f"{i}_{label}")
        for i, name in enumerate(columns) for label, make in aggregates.items()
    ])
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{i}_{label}").alias(label) for label in aggregates])
        for i, name in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Bag union with a column naming the frame each row came from."""
    return stack([frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First rows in a total order; Spark keeps only ``n`` per task before merging."""
    return df.orderBy(*order).limit(n)


def best_row(df: DataFrame, metric: str, ordinal: str) -> DataFrame:
    """Row with the highest metric; the lowest ordinal wins ties."""
    return top_n(df, [F.desc(metric), F.asc(ordinal)], 1)
