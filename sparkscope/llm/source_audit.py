"""Source divergence audit: how far the term use of sources of a language lies apart.

One scan counts the terms of every (lang, source) group, in how many documents each occurs,
and the groups themselves. A language keeps the terms of at least ``min_docs`` of its
documents; every kept term has a smoothed share p in every group, in parts of 10^9.

The group-term count matrix of a language is cut into blocks of about ``COLUMNS`` terms and
tiles of about ``ROWS`` groups. A task holds two tiles of one block as K-squared trees (K = 2):
a quadrant is uniform if all its counts are zero, all others are divided down to leaves.
Both trees are walked together. Where the quadrants of both tiles are uniform, a pair of
groups differs by the same amount in each of their columns, so that these cost one product;
leaves with counts are compared for all their pairs of groups at once. Blocks are summed
per pair. One hot source or term is a row or column of its blocks and never a task of its own.

All arithmetic is in integers: the shares are divided digit by digit (exact for up to 9e15
counted terms), their differences stay below 2^60.

Defined results: null text, lang and source read as ''. Every occurring group has its rows,
without kept terms all its pairs have the value 0. Ties are ranked by the item's UTF-8
bytes. Repeated rows count as often as they occur. An empty table gives no rows; other
columns are ignored. Very long texts are counted whole, a block of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.llm.common import ship, sized
from sparkscope.llm.textkit import Words, blocks, text_values
from sparkscope.runtime import materialize

MIN_DOCS = 10
TOP_TERMS = 10
#: A block of the matrix: about so many terms, and tiles of about so many groups.
COLUMNS, ROWS = 1024, 256
#: A leaf of the trees.
LEAF_ROWS, LEAF_COLUMNS = 16, 64

_BYTES = np.arange(256)
#: Bytes of a term after lower-casing: a to z and all of a character beyond ASCII.
TERM = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of each block of texts, and a row without term for each group."""
    for batch in batches:
        texts = text_values(batch.column("text"))
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for low, high in blocks(texts):
            groups = {}
            of = np.array([groups.setdefault(x, len(groups)) for x in zip(langs[low:high], sources[low:high])], np.int64)
            names = list(groups)
            words = Words(texts[low:high], TERM)
            out_group, out_term, out_n, out_docs = [*range(len(names))], [None] * len(names), [0] * len(names), [0] * len(names)
            if len(words):
                values, first, term = np.unique(words.hashes(), return_index=True, return_inverse=True)
                doc = words.doc
                cell = of[doc] * len(values) + term
                order = np.lexsort((doc, cell))
                cell, doc = cell[order], doc[order]
                fresh = np.ones(len(cell), bool)
                fresh[1:] = cell[1:] != cell[:-1]
                start = np.flatnonzero(fresh)
                other = fresh.copy()
                other[1:] |= doc[1:] != doc[:-1]
                spelled = [words.bytes_of(i).decode("utf-8", "replace") for i in first]
                out_group += (cell[start] // len(values)).tolist()
                out_term += [spelled[i] for i in cell[start] % len(values)]
                out_n += np.diff(start, append=len(cell)).tolist()
                out_docs += np.add.reduceat(other.astype(np.int64), start).tolist()
            yield pa.record_batch(
                [pa.array([names[g][0] for g in out_group], pa.string()), pa.array([names[g][1] for g in out_group], pa.string()),
                 pa.array(out_term, pa.string()), pa.array(out_n, pa.int64()), pa.array(out_docs, pa.int64())],
                ["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), by long division to base 1000."""
    whole, rest = total + 2 * terms, count + 2
    parts = _div(rest, whole)
    for _ in range(3):
        rest = (rest % whole) * 1000
        parts = parts * 1000 + _div(rest, whole)
    return 1 + parts


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


# --- the trees ----------------------------------------------------------------------

def occupied(counts: np.ndarray) -> list[np.ndarray]:
    """Levels of a K-squared tree from the leaves up: which quadrants hold a count."""
    level = counts.reshape(counts.shape[0] // LEAF_ROWS, LEAF_ROWS, counts.shape[1] // LEAF_COLUMNS, LEAF_COLUMNS).any((1, 3))
    side = 1
    while side < max(level.shape):
        side *= 2
    grid = np.zeros((side, side), bool)
    grid[: level.shape[0], : level.shape[1]] = level
    levels = [grid]
    while side > 1:
        side //= 2
        levels.append(levels[-1].reshape(side, 2, side, 2).any((1, 3)))
    return levels


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tile:
    """Groups x terms of a block, padded to whole leaves: shares (``bare`` where the count is zero) and the tree."""

    def __init__(self, bare: np.ndarray, row: np.ndarray, column: np.ndarray, p: np.ndarray, padded: tuple[int, int]):
        self.rows = len(bare)
        self.bare = np.ones(padded[0], np.int64)
        self.bare[: self.rows] = bare
        self.p = np.repeat(self.bare[:, None], padded[1], 1)
        self.p[row, column] = p
        filled = np.zeros(padded, bool)
        filled[row, column] = True
        self.levels = occupied(filled)


def compare(a: Tile, b: Tile, columns: int) -> np.ndarray:
    """Sum over ``columns`` terms of the divergence of every group of ``a`` from every group of ``b``."""
    total = np.zeros((len(a.bare), len(b.bare)), np.int64)
    zero = np.zeros_like(total)  # columns priced by their number
    todo = [(len(a.levels) - 1, 0, 0, 0)]
    while todo:
        level, i, j, k = todo.pop()
        high, wide = LEAF_ROWS << level, LEAF_COLUMNS << level
        low = k * wide
        width = min(columns, low + wide) - low
        if width <= 0 or i * high >= a.rows or j * high >= b.rows or (a is b and j < i):
            continue  # outside, or the mirror image within one tile
        own, other = (t.levels[level][r, k] for t, r in ((a, i), (b, j)))
        rows, others = slice(i * high, (i + 1) * high), slice(j * high, (j + 1) * high)
        if not own and not other:
            zero[rows, others] += width
        elif level:
            todo += [(level - 1, 2 * i + x, 2 * j + y, 2 * k + z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]
        else:
            left, right = a.p[rows, None, low: low + width], b.p[None, others, low: low + width]
            total[rows, others] += apart(left, right).sum(2)
    return (total + zero * apart(a.bare[:, None], b.bare[None, :]))[: a.rows, : b.rows]


def compared(key: tuple, cells: pa.Table, heads: pa.Table) -> pa.Table:
    """Two tiles of one block: cells (tile, source, term, docs, p), heads (tile, source, bare, width) to sums per pair."""
    lang, _, at, to = (x.as_py() for x in key)
    sources = heads["source"].to_pylist()
    head_tile, bare = heads["tile"].to_numpy(), heads["bare"].to_numpy()
    members = {t: np.flatnonzero(head_tile == t) for t in {at, to}}
    out = {c: pa.array([], pa.string()) for c in ("lang", "a", "b")} | {"value": pa.array([], pa.int64())}
    if not all(len(x) for x in members.values()):
        return pa.table(out)
    width = heads["width"][0].as_py()
    # The most frequent terms first, so that uniform quadrants are large.
    spelled, terms = cells["term"].to_pylist(), {}
    for i in np.argsort(-cells["docs"].to_numpy(), kind="stable"):
        terms.setdefault(spelled[i], len(terms))
    padded = tuple(max(1, -(-n // leaf)) * leaf for n, leaf in ((max(map(len, members.values())), LEAF_ROWS), (len(terms), LEAF_COLUMNS)))
    cell_tile, cell_source, p = cells["tile"].to_numpy(), cells["source"].to_pylist(), cells["p"].to_numpy()
    tiles = {}
    for t, own in members.items():
        place = {sources[i]: row for row, i in enumerate(own)}
        mine = np.flatnonzero(cell_tile == t)
        tiles[t] = Tile(bare[own], np.array([place[cell_source[i]] for i in mine], np.int64),
                        np.array([terms[spelled[i]] for i in mine], np.int64), p[mine], padded)
    a, b = tiles[at], tiles[to]
    # Columns of the block without a count in either tile are one more uniform quadrant.
    value = compare(a, b, len(terms)) + (width - len(terms)) * apart(a.bare[: a.rows, None], b.bare[None, : b.rows])
    one, two = np.triu_indices(a.rows, 1) if at == to else (x.ravel() for x in np.indices(value.shape))
    names = {t: [sources[i] for i in own] for t, own in members.items()}
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "a": pa.array([names[at][i] for i in one], pa.string()),
                     "b": pa.array([names[to][i] for i in two], pa.string()), "value": pa.array(value[one, two], pa.int64())})


# --- the audit ----------------------------------------------------------------------

def ranked(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rows = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return rows if limit is None else rows.where(F.col("rank") <= limit)


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, columns: int = COLUMNS,
                      rows: int = ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for every other source, ``term`` rows for the typical terms."""
    ship(docs.sparkSession)
    read = docs.select(F.col("text").cast("binary").alias("text"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    counts = materialize(
        read.mapInArrow(counted, "lang string, source string, term string, n bigint, docs bigint")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = materialize(
        counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    cells = materialize(
        counts.select("lang", "source", "term", "n").join(sized(kept), ["lang", "term"]), "cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source")
    sizes = groups.groupBy("lang").agg(F.count("*").alias("groups"))
    groups = (groups.join(totals, ["lang", "source"], "left").join(langs.join(sizes, "lang", "right"), "lang")
              .na.fill(0, ["total", "terms", "lang_total"]))
    blocks_of = F.ceil(F.col("terms") / columns).cast("bigint")
    groups = materialize(groups.select(
        "lang", "source", "total", "terms", "lang_total", F.greatest(F.lit(1), blocks_of).alias("blocks"),
        F.ceil(F.col("groups") / rows).cast("bigint").alias("tiles"),
        F.when(F.col("terms") > 0, share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))).otherwise(1).alias("bare"))
        .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles")), "groups")

    priced = cells.join(sized(groups), ["lang", "source"]).select(
        "lang", "source", "term", "docs", "tile", "tiles", F.pmod(F.xxhash64("term"), "blocks").alias("block"),
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    priced = materialize(priced, "priced")

    def meetings(frame: DataFrame) -> DataFrame:
        """Every row to each pair of tiles that its tile belongs to."""
        other = frame.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        return other.select("*", F.least("tile", "other").alias("at"), F.greatest("tile", "other").alias("to")).drop("other", "tiles")

    widths = (kept.join(sized(groups.select("lang", "blocks").distinct()), "lang")
              .groupBy("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block")).agg(F.count("*").alias("width")))
    heads = (groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .join(sized(materialize(widths, "widths")), ["lang", "block"], "left").na.fill(0, ["width"])
             .select("lang", "source", "bare", "block", "width", "tile", "tiles"))
    key = ["lang", "block", "at", "to"]
    sums = (meetings(priced.drop("q")).groupBy(*key).cogroup(meetings(heads).groupBy(*key))
            .applyInArrow(compared, "lang string, a string, b string, value bigint"))
    sums = materialize(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "sums")
    pairs = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    typical = priced.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    return ranked(pairs, "pair").union(ranked(typical, "term", top_terms))
