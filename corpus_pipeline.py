"""Training-corpus pipeline over ``documents``: every stage keeps a part of what its predecessor kept.

Toxic documents go, then all but one of equal texts, all but one of each group of near
copies, documents that hold benchmark passages, and last the sources are mixed to target
weights. A document is a row, known by its id and its text, so rows that share an id (or
have none) are judged each by its own text; of rows with equal id and text exact dedup
leaves one. Null texts count as empty. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkscope.llm.common import sized
from sparkscope.llm.decontaminate import LOWER, UPPER, contamination
from sparkscope.llm.exact_dedup import exact_duplicates
from sparkscope.llm.jaccard_join import jaccard_components
from sparkscope.llm.mixing import mix_sources
from sparkscope.llm.toxicity import toxicity_scores
from sparkscope.runtime import materialize

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near copies share this part of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def normalised_sha() -> Column:
    return F.sha2(F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER), 256)


def without(docs: DataFrame, judged: DataFrame, key: Column, judged_key: str, stays: Column) -> DataFrame:
    """``docs`` without the rows, known by id and ``key``, of which ``judged`` lets none stay.

    What goes is usually the smaller part: its keys are broadcast if they measure small.
    """
    gone = judged.groupBy(F.col("doc_id").alias("gone_id"), F.col(judged_key).alias("gone_key")).agg(
        F.max(stays).alias("stays")).where("not stays").select("gone_id", "gone_key")
    gone = sized(materialize(gone, "gone"))
    return docs.select(DOCUMENTS).join(
        gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (key == F.col("gone_key")), "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score of the threshold or more go."""
    scores = toxicity_scores(docs.select("doc_id", "text", text_hash().alias("text_hash")),
                             spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=["text_hash"])
    return without(docs, scores, text_hash(), "text_hash", F.col("predicted") == 0)


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the largest id stays.

    Only rows whose id occurs more than once, if any, are compared as rows: of those with equal
    id and text (A-Z lower-cased) the first by text and other columns stays.
    """
    stay = without(docs, exact_duplicates(docs), normalised_sha(), "text_sha256", F.col("kept"))
    repeated = docs.groupBy(F.col("doc_id").alias("repeated_id")).count().where("count > 1")
    repeated = sized(materialize(repeated.select("repeated_id"), "repeated"))
    same_id = F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    alike = Window.partitionBy("doc_id", normalised_sha()).orderBy("text", "lang", "source", "n_chars")
    first = (stay.join(repeated, same_id, "left_semi").withColumn("place", F.row_number().over(alike))
             .where("place = 1").select(DOCUMENTS))
    return stay.join(repeated, same_id, "left_anti").union(first)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of linked documents the one with the smallest id stays (no id last, then by text hash)."""
    linked = jaccard_components(docs.select("doc_id", "text", text_hash().alias("text_hash")), NEAR_WORDS, NEAR_PERCENT, 100,
                                carry=["text_hash"])
    order = Window.partitionBy("component").orderBy(F.asc_nulls_last("doc_id"), "text_hash")
    first = (linked.where("component is not null").withColumn("place", F.row_number().over(order)).where("place = 1")
             .select("doc_id", "text_hash", F.lit(True).alias("stays")))
    alone = linked.where("component is null").select("doc_id", "text_hash", F.lit(True).alias("stays"))
    judged = linked.select("doc_id", "text_hash", F.lit(False).alias("stays")).union(first).union(alone)
    return without(docs, judged, text_hash(), "text_hash", F.col("stays"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark window go."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found, text_hash(), "text_hash", ~F.col("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: what the mix takes of every document, in words."""
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


STAGES = [("toxicity", without_toxic), ("exact_dedup", one_of_each_text), ("jaccard_join", one_of_near_copies),
          ("decontaminate", without_benchmark), ("mix_sources", mixed)]
#: A trained classifier decides in the first stage, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(DOCUMENTS)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
