"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every task normalises its texts (A-Z to lower case, on the UTF-8 bytes) and hashes
   them. Only ids and hashes are written, with the number of the source partition.
2. Every source partition sends each owner of a range of the hash space its sorted
   distinct fingerprints, as Golomb (Rice) coded gaps of about 20 bits each.
3. An owner decodes what it got, finds the fingerprints that two or more sources hold
   and returns a bitmap to each source.
4. A source combines the bitmaps with its own repeats. Texts whose bit is clear are
   unique and never move. The others are suspects: they are grouped by their bytes, with
   a partial grouping in each task, so of any number of copies one per task is shuffled.

Defined results: a null text is empty, and all empty texts are one group. Of equal texts
the largest doc_id stays, null ids being smallest; of rows repeated with the same id one
stays. Texts of any length are hashed and compared whole. An empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import pick_rows, ship
from sparkscope.llm.textkit import text_values
from sparkscope.runtime import materialize

HASHES_PER_OWNER = 1 << 18
#: Bits of a fingerprint beyond log2(rows): one unique row in 2^SPARE_BITS is suspected in vain.
SPARE_BITS = 12


def rice_encode(sorted_values: np.ndarray, span: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct values below ``span`` as (remainder bits, unary quotients, remainders)."""
    gaps = np.diff(sorted_values.astype(np.uint64), prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, 0.69 * span / max(1, len(gaps))))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(remainders).tobytes()


def rice_decode(n: int, k: int, unary: bytes, remainders: bytes) -> np.ndarray:
    zeros = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    gaps = (np.diff(zeros, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(remainders, np.uint8))[: n * k].reshape(n, k).astype(np.uint64)
        gaps += bits @ (np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64))
    return np.cumsum(gaps)


def normalised(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, row, sha) of every text, or (sha, norm) with the normalised bytes."""
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        norm = [x.lower() for x in text_values(batch.column("text"))]  # bytes: only A-Z change
        sha = pa.array([hashlib.sha256(x).digest() for x in norm], pa.binary())
        if with_text:
            yield pa.record_batch([sha, pa.array(norm, pa.binary())], ["sha", "norm"])
        else:
            row = pa.array(np.arange(seen, seen + len(norm)), pa.int64())
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.full(len(norm), part), pa.int32()), row, sha],
                                  ["doc_id", "part", "row", "sha"])
        seen += len(norm)


def short_prints(sha: pa.Array, bits: int) -> np.ndarray:
    """The first ``bits`` bits of each SHA-256."""
    heads = np.frombuffer(b"".join(x[:8] for x in sha.to_pylist()), ">u8")
    return heads.astype(np.uint64) >> np.uint64(64 - bits)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hashes_per_owner: int = HASHES_PER_OWNER, spare_bits: int = SPARE_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    hashed = materialize(rows.mapInArrow(
        lambda batches: normalised(batches, False), f"doc_id {id_type}, part int, row bigint, sha binary"), "hashes")
    total = hashed.count()
    owners_wanted = max(1, total // hashes_per_owner, int(spark.conf.get("spark.sql.shuffle.partitions")))
    owner_bits = (owners_wanted - 1).bit_length()
    bits = min(60, max(1, total).bit_length() + spare_bits + owner_bits // 4)
    owner_bits = min(owner_bits, bits)
    span = 1 << (bits - owner_bits)

    def owned(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct fingerprints and where each owner's range begins among them."""
        prints = np.unique(prints)
        edges = np.arange((1 << owner_bits) + 1, dtype=np.uint64) * np.uint64(span)
        return prints, np.searchsorted(prints, edges)

    def send(table: pa.Table) -> pa.Table:
        prints, edges = owned(short_prints(table["sha"].combine_chunks(), bits))
        out = []
        for owner in np.flatnonzero(np.diff(edges)):
            own = prints[edges[owner]: edges[owner + 1]] - np.uint64(int(owner) * span)
            out.append((table["part"][0].as_py(), int(owner), len(own), *rice_encode(own, span)))
        names = ["part", "owner", "n", "k", "unary", "rest"]
        return pa.table({c: [x[i] for x in out] for i, c in enumerate(names)}, schema=pa.schema([
            ("part", pa.int32()), ("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()),
            ("unary", pa.binary()), ("rest", pa.binary())]))

    def answer(table: pa.Table) -> pa.Table:
        got = table.to_pylist()
        lists = [rice_decode(x["n"], x["k"], x["unary"], x["rest"]) for x in got]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[counts > 1]
        marks = [np.packbits(np.isin(x, shared)).tobytes() for x in lists]
        return pa.table({"part": [x["part"] for x in got], "owner": [x["owner"] for x in got], "bitmap": marks},
                        schema=pa.schema([("part", pa.int32()), ("owner", pa.int32()), ("bitmap", pa.binary())]))

    def mark(table: pa.Table, bitmaps: pa.Table) -> pa.Table:
        own = short_prints(table["sha"].combine_chunks(), bits)
        prints, edges = owned(own)
        shared = np.zeros(len(prints), bool)
        for x in bitmaps.to_pylist():
            low, high = edges[x["owner"]], edges[x["owner"] + 1]
            shared[low:high] = np.unpackbits(np.frombuffer(x["bitmap"], np.uint8))[: high - low]
        at = np.searchsorted(prints, own)
        suspect = shared[at] | (np.bincount(at, minlength=len(prints))[at] > 1)
        return table.append_column("suspect", pa.array(suspect))

    sent = hashed.select("part", "sha").groupBy("part").applyInArrow(
        send, "part int, owner int, n int, k int, unary binary, rest binary")
    bitmaps = sent.groupBy("owner").applyInArrow(answer, "part int, owner int, bitmap binary")
    marked = materialize(hashed.groupBy("part").cogroup(bitmaps.groupBy("part")).applyInArrow(
        mark, f"doc_id {id_type}, part int, row bigint, sha binary, suspect boolean"), "marked")

    suspects = marked.where("suspect")
    texts = pick_rows(rows, suspects.select("doc_id"), ["doc_id"]).mapInArrow(
        lambda batches: normalised(batches, True), "sha binary, norm binary")
    same = texts.groupBy("sha", "norm").agg(F.count("*").alias("group_size")).select("sha", "group_size")
    top = suspects.groupBy(F.col("sha").alias("top_sha")).agg(
        F.max(F.struct("doc_id", "part", "row")).alias("top"))
    groups = materialize(same.join(top, F.col("sha") == F.col("top_sha")).select(
        F.col("sha").alias("group_sha"), "group_size", "top"), "groups")
    joined = marked.join(groups, F.col("sha") == F.col("group_sha"), "left")
    alone = F.col("group_sha").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | ((F.col("part") == F.col("top.part")) & (F.col("row") == F.col("top.row")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
