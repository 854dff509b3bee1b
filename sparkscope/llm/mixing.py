"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

1. Every source gets a target in words from its weight; targets stop at a multiple of the
   source's own size and what is over goes to the others by weight (water filling).
2. The mix is a number of blocks of ``block_words`` words. Sources get whole numbers of
   blocks by highest quotients target / (2 * seats - 1), and each source's blocks go to its
   shards (hash ranges of documents) in the same way, by their words.
3. In a shard, documents lie one after another in an order given by a hash of their id, cut
   into blocks. A shard takes all its blocks as often as its quota covers them, and of the
   last round an evenly spaced set of blocks with a seeded start. What a document gives
   follows from its position alone, so no block is ever a row.

Quotas and positions use integers and hashes of ids only: reruns and any partitioning
agree. Single windows run over one row per source, and per source over one row per shard.

Defined results: a null text has size 0 and gives 0; a null source is a source of its
own, last in order; null ids order as empty text; rows repeated with the same id are
separate documents. Texts of any length are counted whole. An empty table, or one without words,
gives targets of 0; other columns are ignored.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkscope.llm.common import sized
from sparkscope.runtime import materialize

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 21
SEED = "mix"


def hash_number(text: Column, start: int) -> Column:
    """Eight hexadecimal digits of the MD5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def apportion(parts: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """Add ``quota``: whole seats per row by highest quotients (Sainte-Laguë), ties by key.

    Each row first gets what it is sure of; only the few seats after that, at most
    one per row's share of the rows plus three, are ranked by their quotients.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ranked = whole.orderBy(F.desc("__quotient"), key)
    sure = F.greatest(F.lit(0), F.floor(F.col(weight) * (F.col(seats) - F.col("__n") / 2) / F.col("__all") + 0.5) - 1)
    based = (parts.withColumn("__n", F.count("*").over(whole)).withColumn("__all", F.sum(F.col(weight).cast("double")).over(whole))
             .withColumn("__base", F.when(F.col("__all") > 0, sure).otherwise(0).cast("bigint"))
             .withColumn("__open", F.col(seats) - F.sum("__base").over(whole)))
    offers = F.when(F.col("__all") > 0, F.ceil(F.col("__n") * F.col(weight) / F.col("__all")) + 3).otherwise(1)
    seat = based.withColumn("__seat", F.explode(F.sequence(F.lit(1).cast("bigint"), offers.cast("bigint"))))
    seat = seat.withColumn("__quotient", F.col(weight) / (2 * (F.col("__base") + F.col("__seat")) - 1))
    seat = seat.withColumn("__won", (F.row_number().over(ranked) <= F.col("__open")) & (F.col(weight) > 0))
    return seat.groupBy(*parts.columns, "__base").agg(F.sum(F.col("__won").cast("bigint")).alias("__more")).select(
        *parts.columns, (F.col("__base") + F.col("__more")).alias("quota"))


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source (source, source_key, source_size)."""
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_room = everything.orderBy("room", "source_key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    steps = (sources.withColumn("weight", weight)
             .withColumn("room", F.col("source_size") * (F.lit(lcm(*weights)) / F.col("weight")).cast("bigint"))
             .withColumn("total", F.sum("source_size").over(everything))
             .withColumn("before", most * (F.sum("source_size").over(by_room) - F.col("source_size")))
             .withColumn("left", F.sum("weight").over(everything) - F.sum("weight").over(
                 by_room.rowsBetween(Window.unboundedPreceding, 0)) + F.col("weight"))
             .withColumn("level", (F.lit(share) * F.col("total") - F.col("before")) / F.col("left")))
    return steps.withColumn("target", F.least(
        F.col("weight") * F.max("level").over(everything), (most * F.col("source_size")).cast("double"))).select(
        *sources.columns, "weight", "target")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2,
                block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, shard): words the mix takes of each document."""
    digest = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sizes = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), source_col)).alias("source_key"),
        F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        hash_number(digest, 1).alias("pick"), hash_number(digest, 9).alias("place")), "sizes")
    sources = sizes.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("bigint")
    quotas = apportion(source_targets(sources, weights, share, most).withColumn("seats", seats), [], "source_key", "target", "seats")
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint")
    quotas = sized(materialize(quotas.select("source_key", "source_size", "target", "quota", shards_of.alias("shards")), "quotas"))
    dealt = sizes.join(quotas, "source_key").withColumn("shard", F.col("pick") % F.col("shards"))
    shards = dealt.groupBy("source_key", "shard", "quota").agg(F.sum("size").alias("shard_size"))
    shards = apportion(shards.withColumnRenamed("quota", "seats"), ["source_key"], "shard", "shard_size", "seats")
    blocks = F.ceil(F.col("shard_size") / block_words).cast("bigint")
    start = hash_number(F.concat_ws("/", F.lit(seed), F.col("source_key"), F.col("shard").cast("string")), 1)
    shards = sized(materialize(shards.withColumn("blocks", F.greatest(F.lit(1).cast("bigint"), blocks)).select(
        "source_key", "shard", "blocks", F.least("quota", 2 * F.col("blocks")).alias("own_quota"),
        (start % F.col("blocks")).alias("start")), "shards"))
    order = Window.partitionBy("source_key", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(order)).join(shards, ["source_key", "shard"])
    rest = F.col("own_quota") % F.col("blocks")
    times = F.expr("own_quota div blocks")

    def picked(block: Column) -> Column:
        """How many of the blocks before ``block`` the last round takes."""
        return F.floor((block * rest + F.col("start")) / F.col("blocks"))

    def taken_to(words: Column) -> Column:
        block, inside = F.floor(words / block_words), words % block_words
        return times * words + block_words * picked(block) + inside * (picked(block + 1) - picked(block))

    taken = taken_to(F.col("end")) - taken_to(F.col("end") - F.col("size"))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "source", "shard")
