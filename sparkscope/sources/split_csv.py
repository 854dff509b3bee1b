"""Parallel scan of large quoted CSV files.

A line break inside quotes does not end a record, so a task that starts in the middle of a
file cannot know whether it stands inside a value. But it can count quotes: by RFC 4180 a
position is inside a value exactly if an odd number of quotes precedes it (a doubled quote
counts twice). So

1. one pass counts the quotes of every split of the text, and a running sum over the splits
   of a file says for each whether it begins inside a value;
2. a second pass cuts every split into records. What a split border cuts apart, at most two
   pieces a split, is put together afterwards.

Both passes read the files with Spark's own text source, so any store works and large
files are split like other text (``spark.sql.files.maxPartitionBytes``). The records are
parsed by Spark's CSV parser and written once. Between the passes only one number a split
goes to the driver and out again: 100 TB in splits of 128 MB are 800,000 of them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkscope.runtime import materialize
from sparkscope.sources.tables import SNAPSHOT_SCHEMA

RECORD, HEAD, TAIL = 0, 1, 2


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, quotes, line``: every line with the split it was read from."""
    lines = spark.read.text(path, lineSep="\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        quotes.cast("bigint").alias("quotes"), F.col("value").alias("line"))


def split_parity(lines: DataFrame) -> dict[str, dict[int, bool]]:
    """For each file and split: does it begin inside a quoted value?"""
    counts = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")).toArrow()
    found: dict[str, dict[int, int]] = {}
    for file, block, quotes in zip(*(counts[c].to_pylist() for c in ("file", "block", "quotes"))):
        found.setdefault(file, {})[block] = quotes
    inside = {}
    for file, blocks in found.items():
        places = sorted(blocks)
        sums = [0, *accumulate(blocks[b] for b in places)]
        if sums[-1] % 2:
            raise ValueError(f"{file}: a quote is never closed; quotes inside values must be doubled and the value quoted")
        inside[file] = {b: bool(n % 2) for b, n in zip(places, sums)}
    return inside


def cut_records(batches: Iterator[pa.RecordBatch], inside: Mapping[str, Mapping[int, bool]], names: Sequence[str] | None
                ) -> Iterator[pa.RecordBatch]:
    """Lines in file order to ``file, block, part, text``: whole records, and the pieces at the ends of a split.

    A header record of the expected ``names`` is left out at the start of every file.
    """
    at, odd, open_lines, started = None, False, [], False

    def rows(part: int, texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        return pa.record_batch([pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()),
                                pa.array([part] * n, pa.int32()), pa.array(texts, pa.string())], ["file", "block", "part", "text"])

    def without_header(texts: list[str]) -> list[str]:
        nonlocal headless
        if headless and texts:
            headless = False
            own = next(csv.reader([texts[0].removesuffix("\r").removeprefix("\ufeff")], strict=True), [])
            if own != list(names):
                raise ValueError(f"{at[0]}: header {own} differs from the schema {list(names)}")
            return texts[1:]
        return texts

    def rest() -> Iterator[pa.RecordBatch]:
        """What is left of a split after its last line."""
        if headless and open_lines:
            raise ValueError(f"{at[0]}: the header is longer than a split")
        if open_lines:
            yield rows(TAIL if started else HEAD, ["\n".join(open_lines)])

    headless = False
    for batch in batches:
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        quotes, lines = batch.column("quotes").to_numpy(), batch.column("line")
        names_of = files.to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((np.diff(blocks) != 0) | (names_of[1:] != names_of[:-1])) + 1)] if len(blocks) else []
        for low, high in zip(edges, [*edges[1:], len(blocks)]):
            here = (files[low].as_py(), int(blocks[low]))
            if here != at:
                yield from rest()
                if here[0] not in inside or here[1] not in inside[here[0]]:
                    raise RuntimeError("the files were split differently in the second pass; fix spark.sql.files.minPartitionNum")
                at, odd, open_lines = here, inside[here[0]][here[1]], []
                started, headless = not odd, names is not None and here[1] == 0
            before = (int(odd) + np.cumsum(quotes[low:high]) - quotes[low:high]) % 2
            odd = bool((int(odd) + int(quotes[low:high].sum())) % 2)
            starts = np.flatnonzero(before == 0)
            texts = lines.slice(low, high - low).to_pylist()
            if not len(starts):
                open_lines += texts
                continue
            # What was open ends before the first start; what follows the last start may go on in the next batch.
            ended = open_lines + texts[: starts[0]]
            whole = ["\n".join(texts[a:b]) if b - a > 1 else texts[a] for a, b in zip(starts[:-1], starts[1:])]
            open_lines = texts[starts[-1]:]
            if ended and not started:
                yield rows(HEAD, ["\n".join(ended)])
            elif ended:
                whole.insert(0, "\n".join(ended))
            started = True
            if not odd:  # the last record is complete
                whole.append("\n".join(open_lines))
                open_lines = []
            whole = without_header([x for x in whole if x not in ("", "\r")])
            if whole:
                yield rows(RECORD, whole)
    yield from rest()


def stitched(pieces: DataFrame) -> DataFrame:
    """Pieces at split borders, put together: a tail and the heads up to the next tail are one record."""
    order = Window.partitionBy("file").orderBy("block", "part")
    numbered = pieces.withColumn("record", F.sum((F.col("part") == TAIL).cast("int")).over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "text"))), lambda x: x["text"]), "\n")
    return numbered.groupBy("file", "record").agg(joined.alias("text")).select("text")


def parsed(text: Column, schema: T.StructType, options: Mapping[str, str]) -> Column:
    bare = F.regexp_replace(text, r"\r\z", "")
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return F.from_csv(bare, ddl, {"escape": '"', "multiLine": "true", **options})


def read_csv_splits(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str = SNAPSHOT_SCHEMA,
                    header: bool = True, options: Mapping[str, str] | None = None) -> DataFrame:
    """Scan CSV files with quoted line breaks, every file by as many tasks as it has splits.

    Equal to ``read_csv(..., multi_line=True)``, but run at once: two passes over the text and
    one written copy of the parsed rows, whose columns are pruned and filtered like those of
    any table. Quotes must be doubled inside quoted values (what Spark and RFC 4180 write); a
    file that leaves a quote open is an error, and so is a header that differs from the schema.
    Values that do not parse are null. ``options`` go to the parser of the records.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = text_lines(spark, path)
    inside = spark.sparkContext.broadcast(split_parity(lines))
    names = schema.fieldNames() if header else None
    pieces = lines.mapInArrow(lambda batches: cut_records(batches, inside.value, names), "file string, block bigint, part int, text string")
    options = dict(options or {})
    row = F.when(F.col("part") == RECORD, parsed(F.col("text"), schema, options)).alias("row")
    kept = F.when(F.col("part") != RECORD, F.col("text")).alias("text")
    written = materialize(pieces.select("file", "block", "part", kept, row), "csv", ["part"])
    inside.unpersist()
    records = written.where(F.col("part") == RECORD).select("row.*")
    cut = stitched(written.where(F.col("part") != RECORD).select("file", "block", "part", "text"))
    return records.unionByName(cut.select(parsed(F.col("text"), schema, options).alias("row")).select("row.*"))
