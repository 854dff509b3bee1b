"""Quantiles of many columns, overall or per group, and median imputation.

``approx_quantiles`` is Spark's sketch. ``exact_quantiles`` gives the exact order
statistics without ever gathering a column: it counts values into bins, keeps
only the bins that hold a wanted rank, splits those again while they are large,
and ranks the distinct values that remain. Each pass is a scan with map-side
counting, so a group or value that holds most of the rows costs one counter, not
one task, and the window that ranks values never sees more than a bounded number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.functions.columns import is_missing, shown
from sparkscope.operators.reshape import stack
from sparkscope.runtime import join_measured, join_summary, materialize, total_bytes

# First pass: logarithmic bins, so no range has to be known in advance.
BINS_PER_OCTAVE = 512
SMALLEST_MAGNITUDE = 2.0 ** -30
# Further passes: equal-width bins inside each bin that is kept.
SUB_BINS = 4096
# A kept bin with more rows than this (and more than one value) is split again.
MAX_RANKED_ROWS = 1_000_000
# Relative accuracy of the one-pass sketch.
SKETCH_ACCURACY = 10_000


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, value`` with one row per input row and named column."""
    picked = df.select(*by, *[F.col(name).cast("double").alias(name) for name in columns])
    return picked.unpivot(list(by), list(columns), "column", "value")


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     by: Sequence[str] = (), accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """``by..., column, p, value`` from a mergeable sketch, in one pass."""
    sketches = df.groupBy(*by).agg(*[
        F.percentile_approx(shown(df, name).cast("double"), list(map(float, probs)), accuracy).alias(name)
        for name in columns
    ])
    rows = sketches.unpivot(list(by), list(columns), "column", "value")
    grid = F.array(*[F.lit(float(p)) for p in probs])
    return rows.select(*by, "column", F.explode(F.arrays_zip(grid.alias("p"), F.col("value").alias("value"))).alias("q")
                       ).select(*by, "column", "q.p", "q.value")


def _wanted_ranks(total: Column, probs: Sequence[float], interpolate: bool) -> Column:
    """Zero-based ranks needed for each probability, as an array of structs."""
    def rank(p: float, side: int, value: Column, weight: Column) -> Column:
        return F.struct(F.lit(float(p)).alias("p"), F.lit(side).alias("side"),
                        value.cast("bigint").alias("rank"), weight.cast("double").alias("weight"))

    ranks = []
    for p in probs:
        if interpolate:
            position = (total - 1) * F.lit(float(p))
            ranks.append(rank(p, 0, F.floor(position), position - F.floor(position)))
            ranks.append(rank(p, 1, F.ceil(position), position - F.floor(position)))
        else:
            ranks.append(rank(p, 0, F.greatest(F.ceil(total * F.lit(float(p))), F.lit(1)) - 1, F.lit(0.0)))
    return F.array(*ranks)


def _bins_with_ranks(bins: DataFrame, keys: list[str], within: list[str], probs: Sequence[float],
                     interpolate: bool) -> DataFrame:
    """Bins that contain a wanted rank, with the number of values before them."""
    group = Window.partitionBy(*keys, *within)
    ordered = group.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") if within else F.lit(0)
    total = F.col("total") if within else F.sum("n").over(group)
    placed = bins.withColumns({
        "total": total,
        "before": start + F.coalesce(F.sum("n").over(ordered), F.lit(0)),
    })
    hit = F.exists(
        _wanted_ranks(F.col("total"), probs, interpolate),
        lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n")),
    )
    return placed.filter(hit).select(*keys, "lo", "hi", "n", "before", "total")


def _ranked_values(inside: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of the open bins with their counts and last ranks."""
    distinct = inside.groupBy(*keys, "before", "total", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys, "before", "total").orderBy("value")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return distinct.withColumn("after", F.col("before") + upto).select(*keys, "value", "n", "after", "total")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), interpolate: bool = False,
                    max_ranked: int = MAX_RANKED_ROWS, cuts: DataFrame | None = None) -> DataFrame:
    """``by..., column, p, value``: exact quantiles of the non-null, non-NaN values.

    Without ``interpolate`` the result is the smallest value whose cumulative
    share reaches ``p``; with it, neighbouring ranks are blended linearly.

    Narrowing down runs at once: each pass writes the bins it keeps, at most two
    per group, column and probability, and looks at their size to choose the join
    and whether to go on. A bin of one distinct value is settled and not read for
    again; a pass separates the smallest from the largest value of every bin it
    splits, so the narrowing always ends. Unless all bins are settled by then, the
    returned frame reads the open columns of ``df`` once more; pass a table, not an
    expensive query.

    The first bins are logarithmic, or lie between the values of ``cuts`` (``by..., column,
    cuts``, an array for every group and column), each of which is a bin of its own.
    """
    keys = [*by, "column"]
    value = F.col("value")
    counted = [F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")]

    def numbers(names: Sequence[str]) -> DataFrame:
        return long_values(df, names, by).filter(value.isNotNull() & ~F.isnan(value))

    if cuts is None:
        octave = F.signum(value) * F.log2(1 + F.abs(value) / SMALLEST_MAGNITUDE)
        first, first_bin = numbers(columns), F.floor(octave * BINS_PER_OCTAVE)
    else:
        first = join_summary(numbers(columns), cuts, keys)
        first_bin = F.size(F.filter("cuts", lambda c: c < value)) + F.size(F.filter("cuts", lambda c: c <= value))
    bins = first.groupBy(*keys, first_bin.alias("bin")).agg(*counted)
    settled: list[DataFrame] = []
    within: list[str] = []
    while True:
        kept = materialize(_bins_with_ranks(bins, keys, within, probs, interpolate), "bins")
        is_open = F.col("hi") > F.col("lo")
        settled.append(kept.filter(~is_open).select(
            *keys, F.col("lo").alias("value"), "n", (F.col("before") + F.col("n")).alias("after"), "total"))
        size, largest, open_columns = kept.filter(is_open).agg(
            total_bytes(kept), F.max("n"), F.collect_set("column")).first()
        if largest is None:
            break
        inside = join_measured(
            numbers(sorted(open_columns)), kept.filter(is_open).drop("n"), size, keys,
            extra=value.between(F.col("lo"), F.col("hi")))
        if largest <= max_ranked:
            settled.append(_ranked_values(inside, keys))
            break
        within = ["before", "total"]
        position = (value - F.col("lo")) / (F.col("hi") - F.col("lo"))
        bins = inside.groupBy(*keys, *within, F.floor(position * SUB_BINS).alias("bin")).agg(*counted)

    wanted = stack(settled).withColumn("want", F.explode(_wanted_ranks(F.col("total"), probs, interpolate)))
    found = wanted.filter((F.col("want.rank") < F.col("after")) & (F.col("want.rank") >= F.col("after") - F.col("n")))
    low = F.max(F.when(F.col("want.side") == 0, value))
    if not interpolate:
        return found.groupBy(*keys, F.col("want.p").alias("p")).agg(low.alias("value"))
    high = F.max(F.when(F.col("want.side") == 1, value))
    weight = F.max("want.weight")
    return found.groupBy(*keys, F.col("want.p").alias("p")).agg((low + (high - low) * weight).alias("value"))


def refined_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                      accuracy: int = SKETCH_ACCURACY, max_ranked: int = MAX_RANKED_ROWS) -> DataFrame:
    """``by..., column, p, value``: exact quantiles, for which the sketch says where to look.

    The sketch's values somewhat below and above each wanted rank are the first bins of
    ``exact_quantiles``, so that about one in ``accuracy / 4`` values is left to rank after one
    counting pass. The result is exact whatever the sketch's errors.
    """
    around = sorted({min(1.0, max(0.0, p + side * 2 / accuracy)) for p in map(float, probs) for side in (-1, 1)})
    cuts = approx_quantiles(df, columns, around, by, accuracy).groupBy(*by, "column").agg(
        F.array_sort(F.collect_set("value")).alias("cuts"))
    return exact_quantiles(df, columns, probs, by, max_ranked=max_ranked, cuts=cuts)


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              accuracy: int | None = SKETCH_ACCURACY) -> DataFrame:
    """Discrete quantiles from a one-pass sketch, or exact when ``accuracy`` is ``None``.

    The sketch's rank error is at most rows / accuracy, rounded up: also among few rows it may give a neighbour.
    """
    if accuracy is None:
        return exact_quantiles(df, columns, probs, by)
    return approx_quantiles(df, columns, probs, by, accuracy)


def rank_errors(df: DataFrame, found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, p, value, n, rank_error``: how far quantiles of ``df`` are from their rank.

    ``found`` has ``by..., column, p, value``, from whatever method. The error is the distance of
    the wanted rank from the ranks that the value holds, as a share of the ``n`` values; an exact
    quantile has none. ``df`` is read once and not shuffled while ``found`` is small.
    """
    keys = [*by, "column"]
    value = F.col("value")
    wanted = found.select(*keys, "p", F.col("value").alias("at"))
    numbers = long_values(df, [row[0] for row in found.select("column").distinct().collect()], by)
    ranked = join_summary(numbers.filter(value.isNotNull() & ~F.isnan(value)), wanted, keys).groupBy(*keys, "p", "at").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value < F.col("at")).alias("below"), F.count_if(value <= F.col("at")).alias("upto"))
    rank = F.greatest(F.ceil(F.col("n") * F.col("p")), F.lit(1))
    off = F.greatest(F.col("below") + 1 - rank, rank - F.col("upto"), F.lit(0))
    return ranked.select(*keys, "p", F.col("at").alias("value"), "n", (off / F.col("n")).alias("rank_error"))


def impute_median(df: DataFrame, zero_is_missing: Mapping[str, bool], exclude_zero: bool = False,
                  accuracy: int | None = SKETCH_ACCURACY) -> DataFrame:
    """Replace missing values (null, NaN) of each named column by the column's median.

    ``zero_is_missing`` maps column to whether zero counts as missing too. The
    median is taken over all non-null values, zeros included, unless
    ``exclude_zero`` is set. The medians enter as a one-row scalar subquery, so
    nothing returns to the driver and no join is planned. The default sketch starts
    no job; the exact median (``accuracy=None``) runs its counting passes at once and
    reads ``df`` several times, so pass it a table, not an expensive query.
    """
    names = list(zero_is_missing)
    df = df.withColumns({name: shown(df, name) for name in names})
    basis = df.select(*[
        F.when(F.col(name) != 0, F.col(name)).alias(name) if exclude_zero and zero else F.col(name)
        for name, zero in zero_is_missing.items()
    ])
    medians = quantiles(basis, names, [0.5], accuracy=accuracy).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("medians"))
    median = medians.scalar()
    return df.withColumns({
        name: F.when(is_missing(name, zero), median[name]).otherwise(F.col(name))
        for name, zero in zero_is_missing.items()
    })
