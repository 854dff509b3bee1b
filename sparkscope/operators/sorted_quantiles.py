"""Exact quantiles of very many groups, from one range-partitioned sort.

Narrowing bins (``exact_quantiles``) counts bins for every group, which is too much when
groups are as many as items. Here the distinct values are counted, sorted by group and value
over range partitions, and numbered there. A group inside one partition is answered where it
lies. Only the first and the last group of a partition may go on in a neighbour; their rows
are placed with the number of rows in the partitions before, at most two numbers a partition.
So a group that holds a third of all rows spreads over a third of the tasks, and a value that
does so is one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.operators.quantiles import _wanted_ranks, long_values
from sparkscope.operators.reshape import stack
from sparkscope.runtime import join_summary, materialize


def changes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Rows that begin another group than the row before; the first row begins one."""
    fresh = np.zeros(table.num_rows, bool)
    fresh[:1] = True
    for key in keys:
        column = table[key].combine_chunks()
        own, before = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(own, before), False).to_numpy(zero_copy_only=False)
        differ |= pc.is_null(own).to_numpy(zero_copy_only=False) != pc.is_null(before).to_numpy(zero_copy_only=False)
        fresh[1:] |= differ
    return fresh


def group_quantiles(value: np.ndarray, n: np.ndarray, starts: np.ndarray, probs: Sequence[float], interpolate: bool) -> np.ndarray:
    """Groups x probabilities, of sorted values with counts; groups begin at ``starts``."""
    upto = np.cumsum(n)
    base = upto[starts] - n[starts]
    total = np.append(base[1:], upto[-1]) - base

    def at(rank: np.ndarray) -> np.ndarray:
        return value[np.searchsorted(upto, base + rank.astype(np.int64), side="right")]

    found = []
    for p in probs:
        if interpolate:
            position = (total - 1) * float(p)
            low = at(np.floor(position))
            found.append(low + (at(np.ceil(position)) - low) * (position - np.floor(position)))
        else:
            found.append(at(np.maximum(np.ceil(total * float(p)), 1) - 1))
    return np.stack(found, 1)


def answered(batches: Iterator[pa.RecordBatch], keys: Sequence[str], probs: Sequence[float], interpolate: bool
             ) -> Iterator[pa.RecordBatch]:
    """Sorted (keys, value, n) of a partition to quantiles of whole groups and numbered rows of those at its ends."""
    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    first = True  # the group in ``held`` may have begun in the partition before

    def row_set(table: pa.Table, settled: bool, p, value, n, upto) -> Iterator[pa.RecordBatch]:
        size = table.num_rows
        columns = [table[k] for k in keys] + [
            pa.array([settled] * size), pa.array(p, pa.float64()), pa.array(value, pa.float64()), pa.array(n, pa.int64()),
            pa.array(upto, pa.int64()), pa.array(np.full(size, part, np.int32))]
        yield from pa.table(columns, [*keys, "settled", "p", "value", "n", "upto", "part"]).combine_chunks().to_batches()

    def numbered(table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = table["n"].to_numpy()
        yield from row_set(table.select(keys), False, [None] * len(n), table["value"].to_numpy(), n, np.cumsum(n))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not changes(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]), keys)[1:].any():
            if not changes(pa.Table.from_batches([batch]), keys)[1:].any():
                held.append(batch)  # all of it belongs to the open group
                continue
        rows = pa.Table.from_batches([*held, batch])
        starts = np.flatnonzero(changes(rows, keys))
        last = int(starts[-1])
        if first and len(starts) > 1:
            yield from numbered(rows.slice(0, int(starts[1])))
            starts, first = starts[1:], False
        if len(starts) > 1:
            begin = int(starts[0])
            whole = rows.slice(begin, last - begin)
            own = starts[:-1] - begin
            found = group_quantiles(whole["value"].to_numpy(), whole["n"].to_numpy(), own, probs, interpolate)
            names = whole.select(keys).take(pa.array(np.repeat(own, len(probs))))
            nothing = [None] * names.num_rows
            yield from row_set(names, True, np.tile(np.array(probs, float), len(own)), found.ravel(), nothing, nothing)
        held = rows.slice(last).to_batches()
    if held:
        yield from numbered(pa.Table.from_batches(held))


def sorted_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                     interpolate: bool = False, parts: int | None = None) -> DataFrame:
    """``by..., column, p, value``: the rows of ``exact_quantiles``, by sorting.

    Runs at once and writes the sorted distinct values of the groups at partition ends and
    the answers of all others. ``parts`` range partitions (by default as many as shuffles
    have) bound what a task sorts.
    """
    keys = [*by, "column"]
    value = F.col("value")
    numbers = long_values(df, columns, by).filter(value.isNotNull() & ~F.isnan(value))
    counts = numbers.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = counts.repartitionByRange(parts, *keys, "value").sortWithinPartitions(*keys, "value")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.select(*keys).schema)
    probs = list(probs)
    found = materialize(ordered.mapInArrow(
        lambda batches: answered(batches, keys, probs, interpolate),
        f"{kinds}, settled boolean, p double, value double, n bigint, upto bigint, part int"), "sorted", ["settled"])
    settled = found.filter("settled").select(*keys, "p", "value")
    cut = found.filter("not settled").select(*keys, "part", "value", "n", "upto")
    ends = cut.groupBy(*keys, "part").agg(F.max("upto").alias("rows"))
    group = Window.partitionBy(*keys)
    ends = ends.select(*keys, "part", F.sum("rows").over(group).alias("total"), F.coalesce(
        F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = join_summary(cut, ends, [*keys, "part"]).withColumn("after", F.col("before") + F.col("upto"))
    placed = placed.withColumn("want", F.explode(_wanted_ranks(F.col("total"), probs, interpolate)))
    placed = placed.filter((F.col("want.rank") < F.col("after")) & (F.col("want.rank") >= F.col("after") - F.col("n")))
    low = F.max(F.when(F.col("want.side") == 0, value))
    if interpolate:
        high, weight = F.max(F.when(F.col("want.side") == 1, value)), F.max("want.weight")
        low = low + (high - low) * weight
    return stack([settled, placed.groupBy(*keys, F.col("want.p").alias("p")).agg(low.alias("value"))])
