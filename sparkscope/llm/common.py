"""Shared pieces of the corpus operators: row picking, id hashing, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscope.runtime import BROADCAST_MAX_BYTES, materialize, total_bytes


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks can import it wherever they run."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "sparkscope.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def sized(df: DataFrame, limit: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """A written table, marked for broadcast only if its measured size is within ``limit``."""
    small = (df.agg(total_bytes(df)).first()[0] or 0) <= limit
    return F.broadcast(df) if small else df


def pick_rows(docs: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``docs`` whose key is in the written table ``keys`` (null-safe)."""
    keys = sized(materialize(keys.distinct(), "keys"))
    renamed = keys.withColumnsRenamed({c: f"__pick_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__pick_{c}"))
    return docs.join(renamed, condition, "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) links: (node, component), component the smallest node.

    Alternating star contraction: every node is linked to the smallest of its
    neighbourhood, from above and from below in turn, until each component is one star.
    Links are written after each round, so lineage stays short and lost executors cost
    a re-read. Hot nodes only ever meet partial minima and a join that is broadcast or
    split by adaptive execution; no neighbourhood is collected.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = materialize(edges.where("a <> b").select(*ends).distinct(), "links")
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sized(materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "low"))
        large = materialize(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                            .distinct(), "links")
        low = sized(materialize(large.groupBy("a").agg(F.min("b").alias("low")), "low"))
        joined = large.join(low, "a")
        small = materialize(
            joined.select("a", F.col("low").alias("b"))
            .union(joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))
            .where("a <> b").distinct(), "links")
        stars = small.select("b").join(small.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() == 0
        many = small.groupBy("a").count().where("count > 1").limit(1).count() > 0
        links = small
        if stars and not many:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
