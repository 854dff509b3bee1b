"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

1. Words and word pairs of every text are hashed into ``buckets``. Their counts over the
   target texts and over all raw texts give two bag-of-n-gram models with add-one smoothing.
2. A text's log importance is the sum of log(target / raw) over its n-grams.
3. Adding independent Gumbel noise and keeping the k largest values draws k texts without
   replacement in proportion to their importance. The noise comes from a hash of the id, so
   reruns and retried tasks draw the same texts.

Both models cover all texts; each task sends one count vector of fixed size. The k-th
largest value is found by counting passes that narrow its range, never by gathering or
sorting the corpus; equal values at the boundary go by id.

Defined results: texts without words have importance 0. A null id counts as empty text.
Repeated rows have equal values; where only some of them fit, row numbers within that tie
decide. Null labels are not target. Without target texts both models are flat and equal.
Texts of any length are counted whole. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.llm.common import ship, sized
from sparkscope.llm.textkit import Words, blocks, ngrams, text_values
from sparkscope.runtime import materialize

BUCKETS = 10_000
KEPT_SHARE = 0.5
BINS = 1024


def features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word and every pair of neighbouring words."""
    hashes, doc = words.hashes(), words.doc
    pairs = ngrams(hashes, 2)
    inside = doc[:-1] == doc[1:]
    both = np.concatenate([hashes, pairs[inside]]) % np.uint64(buckets)
    return np.concatenate([doc, doc[:-1][inside]]), both.astype(np.int64)


def model_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """(2, buckets) n-gram counts: all texts, and the texts marked ``target``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            values, target = text_values(batch.column("text")), batch.column("target").to_numpy(zero_copy_only=False)
            for low, high in blocks(values):
                doc, bucket = features(Words(values[low:high]), buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[target[low:high][doc]], minlength=buckets)
        yield pa.record_batch([pa.array(np.arange(buckets)), pa.array(total[0]), pa.array(total[1])], ["bucket", "raw", "target"])

    rows = texts.mapInArrow(count, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # one row per bucket
    total = np.zeros((2, buckets))
    for row in rows:
        total[:, row["bucket"]] = row["raw"], row["target"]
    return total


def log_ratios(total: np.ndarray) -> np.ndarray:
    raw, target = np.log((total + 1) / (total.sum(axis=1, keepdims=True) + total.shape[1]))
    return target - raw


def weighed(texts: DataFrame, ratios: np.ndarray, others: list[str]) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, out = text_values(batch.column("text")), []
            for low, high in blocks(values):
                doc, bucket = features(Words(values[low:high]), len(sent.value))
                out.append(np.stack([np.bincount(doc, sent.value[bucket], minlength=high - low),
                                     np.bincount(doc, minlength=high - low)]))
            both = np.concatenate(out, axis=1) if out else np.zeros((2, 0))
            yield pa.record_batch([*(batch.column(c) for c in others), pa.array(both[0]), pa.array(both[1].astype(np.int64))],
                                  [*others, "log_importance", "n_grams"])

    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in others)
    return texts.mapInArrow(weigh, f"{schema}, log_importance double, n_grams bigint")


def kth_largest(values: DataFrame, k: int) -> tuple[float, int]:
    """The k-th largest ``value`` and how many rows are above it, by narrowing a histogram."""
    low, high = values.agg(F.min("value"), F.max("value")).first()
    above = 0
    while low < high:
        width = (high - low) / BINS
        if width <= 0 or low + width == low:
            break
        inside = values.where(F.col("value").between(low, high))
        bin_of = F.least(F.floor((F.col("value") - low) / width), F.lit(BINS - 1))
        counted = sorted(inside.groupBy(bin_of.alias("bin")).agg(
            F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect(), reverse=True)
        for row in counted:
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
    return high, above


def importance_sample(docs: DataFrame, target_ids: DataFrame, share: float = KEPT_SHARE, buckets: int = BUCKETS, seed: str = "draw",
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, target, n_grams, log_importance, value, selected): ``share`` of the rows is selected.

    The importance is that of the whole text; its Gumbel noise has scale 1, as for any
    draw of texts by their importance weights.
    """
    ship(docs.sparkSession)
    marks = sized(materialize(target_ids.select(F.col(id_col).alias("target_id")).where("target_id is not null").distinct(), "targets"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).join(
        marks, F.col("doc_id") == F.col("target_id"), "left").select("doc_id", "text", F.col("target_id").isNotNull().alias("target"))
    ratios = log_ratios(model_counts(texts.select("text", "target"), buckets))
    digest = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    scored = materialize(weighed(texts, ratios, ["doc_id", "target"]).withColumn(
        "value", F.col("log_importance") - F.log(-F.log(uniform))), "importance")
    k = round(share * scored.count())
    if k == 0:
        return scored.withColumn("selected", F.lit(False))
    edge, above = kth_largest(scored, k)
    tied = scored.where(F.col("value") == edge)
    ranked = tied.withColumn("rank", F.row_number().over(Window.partitionBy("value").orderBy("doc_id")))
    return (scored.where(F.col("value") != edge).withColumn("selected", F.col("value") > edge)
            .union(ranked.withColumn("selected", F.col("rank") <= k - above).drop("rank")))
