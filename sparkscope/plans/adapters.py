"""The driver's tables seen as snapshot data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscope.operators.rollup import add_ratios, peak_rollup
from sparkscope.plans.prepare import EXTENDED_PREDICTORS, PEAK_COLUMNS, RATES

CATEGORY_OF_PART = "array(10, 23, 34, 24, 1, 2, null, 99, 20, 25, 26, 17)[cast(l_partkey % 12 as int)]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_snapshots(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """``lineitem`` as raw snapshots: parts are items, ship dates are trending days.

    Every kind of flaw the preparation must handle occurs: missing keys and
    measures, zero views, unmapped and missing categories, odd durations.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        *keep,
        "if(l_orderkey % 211 = 0, null, concat('v', l_partkey)) as video_id",
        "if(l_orderkey % 5 = 0, null, concat('title ', l_partkey)) as title",
        "if(l_orderkey % 7 = 0, null, concat('c', l_suppkey)) as channelId",
        "if(l_orderkey % 9 = 0, null, concat('channel ', l_suppkey)) as channelTitle",
        "l_shipdate as publishedAt",
        f"cast({CATEGORY_OF_PART} as string) as categoryId",
        "if(l_orderkey % 223 = 0, null, l_shipdate) as trending_date",
        "case when l_orderkey % 227 = 0 then null when l_partkey % 97 = 0 then 0 else l_extendedprice end as view_count",
        "if(l_orderkey % 17 = 0, null, l_quantity) as likes",
        "l_discount as dislikes",
        "nullif(l_tax, 0) as comment_count",
        "case when l_orderkey % 29 = 0 then null when l_orderkey % 31 = 0 then 'P1DT2H' "
        "when l_orderkey % 37 = 0 then '' "
        "else concat('PT', l_linenumber % 3, 'H', l_orderkey % 60, 'M', l_partkey % 60, 'S') end as duration",
    )


def part_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One modelling row per part: peaks over ``lineitem``, class from ``part``.

    The rollup is already partitioned by the part key, so the join shuffles at
    most the ``part`` side.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("video_id"),
        F.col("l_extendedprice").alias("view_count"),
        F.col("l_quantity").alias("likes"),
        F.col("l_tax").alias("comment_count"),
        (F.col("l_orderkey") % 60 * 60 + F.col("l_linenumber")).cast("int").alias("duration_seconds"),
    )
    peaks = peak_rollup(lines, ["video_id"], PEAK_COLUMNS)
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("video_id"), F.col("p_type").alias("category_name"))
    return add_ratios(peaks.join(parts, "video_id"), RATES)


def separable_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part in one of three classes (key modulo 3) that lines separate, with small variation inside."""
    corner = "element_at(array({}), cast(p_partkey % 3 + 1 as int))"
    near = "(p_size % 10) / 100"
    across = [f"{corner.format('10.0D, 0.0D, -10.0D')} + {near}", f"{corner.format('0.0D, 10.0D, -10.0D')} + {near}"]
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as video_id", "concat('class ', p_partkey % 3) as category_name",
        *[f"{across[i % 2]} as {name}" for i, name in enumerate(EXTENDED_PREDICTORS)])


def grouped_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part in one of four far-apart groups (key modulo 4), with small variation inside."""
    near = "(p_size % 10) / 10"
    across = [f"100D * (p_partkey % 2) + {near}", f"100D * (p_partkey % 4 div 2) + {near}"]
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as video_id", "cast(p_partkey % 4 as int) as grp",
        *[f"{across[i % 2]} as {name}" for i, name in enumerate(EXTENDED_PREDICTORS)])
