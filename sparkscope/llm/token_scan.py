"""Token counts of documents in flat token files without an index.

A token file is one long run of fixed-width ids in which an end-of-document id follows
every document; it is handled as blocks of equal length that ignore document borders.

1. Every block is searched for the end id in one vectorised comparison; it gives its
   length, the places of its ends and the last of them.
2. A prefix scan over the blocks of a file carries the number of tokens, the number of ends
   and the place of the last end so far into each block. It runs in two levels, over blocks
   within a chunk and over chunks within a file, so one huge file is many tasks.
3. Each end minus the end before it, which may lie any number of blocks back, is a document.

``write_token_files`` makes such files from texts, with a public tokenizer whose path is a
parameter; a manifest keeps the ids of the documents in file order. Files are stored as
rows of blocks, so Spark can split them; ``token_file_blocks`` cuts raw binary files.

Defined results: a null or empty text is a document of 0 tokens; end ids in a row are
empty documents; tokens after the last end are a document marked as not complete. Text
that spells a special token is ordinary text. Repeated rows are documents of their own, texts
of any length are encoded whole, null ids are kept. Other columns are ignored. No files give no
rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkscope.llm.common import ship
from sparkscope.llm.textkit import text_values
from sparkscope.runtime import new_path

RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_ID = 50256
#: How the vocabulary's public definition splits text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS = 1 << 16
CHUNK_BLOCKS = 1 << 10
MANIFEST_IDS = 4096


def encoder(ranks_file: str):
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, ranks_file: str = RANKS_FILE, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every partition's texts as one file; rows are blocks (tokens) or pieces of the manifest (doc_ids)."""
    id_type = docs.schema[id_col].dataType
    kind = np.dtype("<u2" if end_id < 1 << 16 else "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, file = encoder(ranks_file), TaskContext.get().partitionId()
        names = ["file", "number", "tokens", "doc_ids"]
        block = documents = waiting = 0
        open_tokens: list[np.ndarray] = []

        def row(number: int, tokens: bytes | None, ids: pa.Array | None) -> pa.RecordBatch:
            listed = pa.nulls(1, pa.list_(id_arrow)) if ids is None else pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.record_batch([pa.array([file], pa.int32()), pa.array([number], pa.int64()),
                                    pa.array([tokens], pa.binary()), listed], names)

        for batch in batches:
            ids = batch.column("doc_id")
            id_arrow = ids.type
            texts = text_values(batch.column("text"))
            for low in range(0, len(ids), MANIFEST_IDS):
                yield row(documents + low, None, ids[low: low + MANIFEST_IDS])
            documents += len(ids)
            for text in texts:
                open_tokens.append(np.array([*encoding.encode_ordinary(text.decode("utf-8", "replace")), end_id], kind))
                waiting += len(open_tokens[-1])
                if waiting >= block_tokens:
                    flat = np.concatenate(open_tokens)
                    waiting = len(flat) % block_tokens
                    for low in range(0, len(flat) - waiting, block_tokens):
                        yield row(block, flat[low: low + block_tokens].tobytes(), None)
                        block += 1
                    open_tokens = [flat[len(flat) - waiting:]]
        flat = np.concatenate([np.zeros(0, kind), *open_tokens])
        for low in range(0, len(flat), block_tokens):
            yield row(block, flat[low: low + block_tokens].tobytes(), None)
            block += 1

    ship(docs.sparkSession)
    spark = docs.sparkSession
    schema = f"file int, number bigint, tokens binary, doc_ids array<{id_type.simpleString()}>"
    path = new_path(spark, "token-files")
    docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        encode, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def token_file_blocks(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, number, tokens) blocks of raw binary token files, one file of up to 2 GB per task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width * block_tokens
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                for number, low in enumerate(range(0, len(data), size)):
                    yield pa.record_batch([pa.array([file]), pa.array([number], pa.int64()),
                                           pa.array([bytes(data[low: low + size])], pa.binary())], ["file", "number", "tokens"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        cut, "file string, number bigint, tokens binary")


def separator_scan(blocks: DataFrame, end_id: int = END_ID, width: int = 2, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """(file, document, begin, n_tokens, complete): documents of (file, number, tokens) blocks."""
    ship(blocks.sparkSession)
    kind = np.dtype(f"<u{width}")
    file_type = blocks.schema["file"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x.as_buffer(), kind) for x in batch.column("tokens")]
            ends = [np.flatnonzero(x == end_id) for x in tokens]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ends])]).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *ends])))
            yield pa.record_batch([batch.column("file"), batch.column("number"), pa.array([len(x) for x in tokens], pa.int64()),
                                   places], ["file", "number", "size", "ends"])

    found = (blocks.where("tokens is not null").select("file", "number", "tokens")
             .mapInArrow(search, f"file {file_type}, number bigint, size bigint, ends array<bigint>")
             .withColumn("chunk", F.floor(F.col("number") / chunk_blocks)).withColumn("n", F.size("ends"))
             .withColumn("last", F.when(F.col("n") > 0, F.element_at("ends", -1))))
    inside = Window.partitionBy("file", "chunk").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file", "chunk")
    zero = F.lit(0).cast("bigint")
    local = (found.withColumn("block_at", F.coalesce(F.sum("size").over(inside), zero))
             .withColumn("block_n", F.coalesce(F.sum("n").over(inside), zero))
             .withColumn("end_at", F.col("block_at") + F.col("last"))
             .withColumn("block_end", F.max("end_at").over(inside))
             .withColumn("is_last", F.col("number") == F.max("number").over(whole)))
    chunks = local.groupBy("file", "chunk").agg(F.sum("size").alias("chunk_size"), F.sum("n").alias("chunk_n"),
                                                F.max("end_at").alias("chunk_last"))
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    file_whole = Window.partitionBy("file")
    chunks = (chunks.withColumn("chunk_at", F.coalesce(F.sum("chunk_size").over(before), zero))
              .withColumn("chunk_docs", F.coalesce(F.sum("chunk_n").over(before), zero))
              .withColumn("chunk_end", F.max(F.col("chunk_at") + F.col("chunk_last")).over(before))
              .withColumn("last_chunk", F.col("chunk") == F.max("chunk").over(file_whole))
              .select("file", "chunk", "chunk_at", "chunk_docs", "chunk_end", "last_chunk"))
    carried = local.join(chunks, ["file", "chunk"]).select(
        "file", "size", "ends", "last", (F.col("chunk_at") + F.col("block_at")).alias("at"),
        (F.col("chunk_docs") + F.col("block_n")).alias("first"), (F.col("is_last") & F.col("last_chunk")).alias("final"),
        F.coalesce(F.col("chunk_at") + F.col("block_end"), F.col("chunk_end"), F.lit(-1).cast("bigint")).alias("previous"))
    open_end = F.col("final") & (F.col("size") > 0) & (F.coalesce("last", F.lit(-1).cast("bigint")) < F.col("size") - 1)
    closing = F.when(open_end, F.array("size"))
    stops = F.concat(F.transform("ends", lambda x: F.struct(x.alias("end"), F.lit(True).alias("complete"))), F.coalesce(
        F.transform(closing, lambda x: F.struct(x.alias("end"), F.lit(False).alias("complete"))),
        F.array().cast("array<struct<end:bigint,complete:boolean>>")))
    each = carried.withColumn("stops", stops).select("file", "at", "first", "previous", "stops", F.posexplode("stops").alias("i", "stop"))
    begin = F.when(F.col("i") == 0, F.col("previous") + 1).otherwise(
        F.col("at") + F.element_at("stops", F.greatest("i", F.lit(1)))["end"] + 1)
    return each.select("file", (F.col("first") + F.col("i")).alias("document"), begin.alias("begin"),
                       (F.col("at") + F.col("stop.end") - begin).alias("n_tokens"), F.col("stop.complete").alias("complete"))


def document_tokens(files: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, file, begin) of written token files, by their manifest."""
    found = separator_scan(files, end_id, 2 if end_id < 1 << 16 else 4)
    manifest = files.where("doc_ids is not null").select("file", "number", F.posexplode("doc_ids").alias("i", "doc_id")).select(
        "file", (F.col("number") + F.col("i")).alias("document"), "doc_id")
    return manifest.join(found, ["file", "document"]).select("doc_id", "n_tokens", "file", "begin")
