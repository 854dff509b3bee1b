"""Plot-ready tables: log histograms, box statistics, pair densities.

The result size depends on bins and groups, never on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.functions.columns import log10_positive, ratio
from sparkscope.operators.quantiles import exact_quantiles, long_values
from sparkscope.runtime import equal_keys, join_summary


def log_histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins of log10(value) per column, empty bins included.

    ``n_dropped`` counts the values a log axis cannot show (null, NaN, zero, negative);
    a column of nothing else keeps its bins, with null edges and no values.
    The ranges are a one-row scalar subquery, so the counting pass needs no join.
    """
    logs = df.select(*[log10_positive(F.col(name).cast("double")).alias(name) for name in columns])
    ranges = logs.agg(F.struct(*[
        F.struct(
            F.min(name).alias("lo"),
            ((F.max(name) - F.min(name)) / bins).alias("width"),
            F.count_if(F.col(name).isNull()).alias("n_dropped"),
        ).alias(name) for name in columns
    ])).scalar()

    def slot(name: str) -> Column:
        x, lo, width = F.col(name), ranges[name]["lo"], ranges[name]["width"]
        last = F.lit(bins - 1)
        return F.when(x.isNotNull(), F.when(width > 0, F.least(F.floor(ratio(x - lo, width)), last)).otherwise(0))

    points = F.array(*[F.struct(F.lit(name).alias("column"), slot(name).cast("int").alias("bin")) for name in columns])
    counts = logs.select(F.inline(points)).filter(F.col("bin").isNotNull()).groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    named = F.array(*[F.struct(F.lit(name).alias("column"), ranges[name].alias("range")) for name in columns])
    grid = df.sparkSession.range(1).select(F.inline(named)).withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    lo, width = F.col("range.lo"), F.col("range.width")
    # At most columns x bins rows on either side.
    return grid.join(F.broadcast(counts), ["column", "bin"], "left").select(
        "column", "bin",
        (lo + F.col("bin") * width).alias("log_lo"),
        (lo + (F.col("bin") + 1) * width).alias("log_hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.col("range.n_dropped").alias("n_dropped"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), ranked: bool = True,
              quantiles: Callable[..., DataFrame] = exact_quantiles) -> DataFrame:
    """Box-and-whisker statistics of log10(value) per column and group.

    Quartiles are linearly interpolated; whiskers reach the outermost value within
    1.5 interquartile ranges of the box. ``rank`` orders groups by median; it sorts
    the groups of a column in one task, so turn it off for very many groups. A group
    or column without positive values is a row of its own, with nulls and ``n_dropped``.
    With as many groups as items, pass ``quantiles=sorted_quantiles``.
    """
    keys = [*by, "column"]
    logs = df.select(*by, *[log10_positive(F.col(name).cast("double")).alias(name) for name in columns])

    def at(p: float) -> Column:
        return F.max(F.when(F.col("p") == p, F.col("value")))

    box = quantiles(logs, columns, [0.25, 0.5, 0.75], by, interpolate=True).groupBy(*keys).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    box = box.withColumns({"fence_lo": F.col("q1") - reach, "fence_hi": F.col("q3") + reach})
    values = long_values(logs, columns, by)
    if by:
        joined = join_summary(values, box, keys, "left")
    else:
        # One row per named column.
        joined = equal_keys(values, F.broadcast(box), keys, "left")
    x = F.col("value")
    within = x.between(F.col("fence_lo"), F.col("fence_hi"))
    stats = joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.count("value").alias("n"),
        F.min(F.when(within, x)).alias("whisker_lo"),
        F.max(F.when(within, x)).alias("whisker_hi"),
        F.count_if(~within).alias("n_outliers"),
        F.count_if(x.isNull()).alias("n_dropped"),
    )
    if not by or not ranked:
        return stats
    order = Window.partitionBy("column").orderBy(F.asc_nulls_last("median"), *by)
    return stats.withColumn("rank", F.row_number().over(order))


def pair_density(df: DataFrame, pairs: Sequence[tuple[str, str]], width: float = 0.1,
                 by: Sequence[str] = ()) -> DataFrame:
    """Counts on a log10-log10 grid for each pair of columns (and group), in one pass.

    Replaces a scatter plot: points outside the positive quadrant drop out and the
    rest are counted per cell.
    """
    def cell(name: str) -> Column:
        return F.floor(log10_positive(F.col(name).cast("double")) / width).cast("int")

    points = F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), cell(x).alias("x_cell"), cell(y).alias("y_cell"))
        for x, y in pairs
    ])
    cells = df.select(*by, F.inline(points)).filter(F.col("x_cell").isNotNull() & F.col("y_cell").isNotNull())
    return cells.groupBy(*by, "x", "y", "x_cell", "y_cell").agg(F.count(F.lit(1)).alias("n"))
