"""Toxicity scores by a bidirectional GRU with attention pooling over word and character inputs.

The model (``gru.py``) is trained in one task on a bounded sample of labelled texts, at
most ``per_class`` of each label, chosen by the hash of their id; its size is fixed by the
number of embedding buckets, so it may be sent to every task. All texts are then scored
whole: overlapping windows cover every word, and a text's score is its worst window's.

Defined results: null, blank and empty texts have no window and get the share of label 1
in the training sample (so does every text if one of the labels does not occur in it, and
0 if there is no label at all). Null labels and labels of unknown documents teach nothing;
a document with several label rows counts with each. A null doc_id is hashed as empty text
and never learned from. Repeated rows get the same score; of several texts under one id the one
with the smallest hash may be learned from. Texts of any length are scored whole, a block of
windows at a time. An empty table gives an empty result; other columns are ignored and never
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkscope.llm import gru
from sparkscope.llm.common import id_remainder, ship, sized
from sparkscope.llm.textkit import Words, blocks, text_values
from sparkscope.runtime import materialize

PER_CLASS = 1200
EPOCHS = 4
THRESHOLD = 0.7


def sample_of(labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled ids of each class, by the hash of the id (top-k per task)."""
    known = labels.where("label is not null and doc_id is not null")
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    return known.where("label = 1").orderBy(*by_hash).limit(per_class).union(
        known.where("label = 0").orderBy(*by_hash).limit(per_class))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, epochs: int = EPOCHS) -> tuple[bytes | None, float]:
    """(packed model, share of label 1 in the sample) from (doc_id, text) and (doc_id, label)."""
    chosen = sized(materialize(sample_of(labels, per_class), "label-sample"))
    # One text of each sampled id, however often the id is repeated: the training task stays bounded.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    texts = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "one.text", "label")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(batch.column("doc_id").to_pylist(), text_values(batch.column("text")),
                                                        batch.column("label").to_pylist(), strict=True)]
        rows.sort(key=lambda row: (str(row[0]), row[2]))
        label = np.array([row[2] for row in rows], np.int64)
        both = len(set(label.tolist())) == 2 and any(len(Words([row[1]])) for row in rows)
        model = gru.pack(gru.train([row[1] for row in rows], label, epochs)) if both else None
        share = float(label.mean()) if len(label) else 0.0
        yield pa.record_batch([pa.array([model], pa.binary()), pa.array([share])], ["model", "share"])

    row = texts.repartition(1).mapInArrow(learn, "model binary, share double").first()
    return (None, 0.0) if row is None else (None if row[0] is None else bytes(row[0]), row[1])


def score_texts(docs: DataFrame, model: bytes | None, share: float, text_col: str = "text", others: list[str] | None = None
                ) -> DataFrame:
    """``others`` and the score of every row."""
    others = ["doc_id"] if others is None else others
    sent = docs.sparkSession.sparkContext.broadcast(model)
    empty = min(1.0, max(0.0, share))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = None if sent.value is None else gru.unpack(sent.value)
        for batch in batches:
            texts = text_values(batch.column("__text"))
            out = np.full(len(texts), empty)
            for low, high in blocks(texts) if p is not None else ():
                words = Words(texts[low:high])
                if len(words):
                    logits, doc = gru.score_windows(p, words)
                    worst = np.full(high - low, -np.inf)
                    np.maximum.at(worst, doc, logits.astype(np.float64))
                    out[low:high] = np.where(worst > -np.inf, gru.sigmoid(worst), empty)
            yield pa.record_batch([*(batch.column(c) for c in others), pa.array(np.clip(out, 0, 1))], [*others, "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, F.col(text_col).cast("binary").alias("__text")).mapInArrow(score, f"{schema}, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, epochs: int = EPOCHS,
                    threshold: float = THRESHOLD, folds: int = 3, held_fold: int = 1, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, *carry, score, predicted); rows whose id hash falls into ``held_fold`` are not learned from.

    ``carry`` names further columns of ``docs``; of an id with several texts the one with the
    smallest hash may be learned from.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                       (id_remainder(id_col, folds) == held_fold).alias("held_out"), *carry)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        id_remainder("doc_id", folds) != held_fold)
    model, share = fit(rows, known, per_class, epochs)
    scored = score_texts(rows, model, share, others=["doc_id", "held_out", *carry])
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
