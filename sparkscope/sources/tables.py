"""Scans, named views, inline dimensions, table profile."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkscope.runtime import BROADCAST_MAX_BYTES

# Columns of a raw snapshot file, in file order.
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("channelId", T.StringType()),
    T.StructField("channelTitle", T.StringType()),
    T.StructField("categoryId", T.StringType()),
    T.StructField("trending_date", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("view_count", T.DoubleType()),
    T.StructField("likes", T.DoubleType()),
    T.StructField("dislikes", T.DoubleType()),
    T.StructField("comment_count", T.DoubleType()),
    T.StructField("thumbnail_link", T.StringType()),
    T.StructField("comments_disabled", T.BooleanType()),
    T.StructField("ratings_disabled", T.BooleanType()),
    T.StructField("description", T.StringType()),
    T.StructField("duration", T.StringType()),
])

# Category id -> name. Ids 23 and 34 share a name; -1 stands for a
# missing id.
CATEGORY_NAMES = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    18: "Short Movies",
    19: "Travel & Events",
    20: "Gaming",
    21: "Videoblogging",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
    29: "Nonprofits & Activism",
    30: "Movies",
    31: "Anime/Animation",
    32: "Action/Adventure",
    33: "Classics",
    34: "Comedy",
    35: "Documentary",
    36: "Drama",
    37: "Family",
    38: "Foreign",
    39: "Horror",
    40: "Sci-Fi/Fantasy",
    41: "Thriller",
    42: "Shorts",
    43: "Shows",
    44: "Trailers",
    -1: "Unknown",
}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = SNAPSHOT_SCHEMA,
             header: bool = True, multi_line: bool = True) -> DataFrame:
    """Scan CSV text with a declared schema; ``schema=None`` infers one (an extra pass).

    A header whose names or order differ from the schema is an error, never read by
    position. Quoted values may hold line breaks; each file is then read by a single
    task, so give it many files, not one big one. ``multi_line=False`` splits large
    files between tasks: a row that a line break cuts, or a value that does not parse,
    is then an error when it is read (``FAILFAST``).
    """
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("enforceSchema", not header).option("mode", "PERMISSIVE" if multi_line else "FAILFAST")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the table available to SQL under a name."""
    df.createOrReplaceTempView(name)
    return df


def inline_dimension(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A lookup table given as literals in the program, marked for broadcast if these are small."""
    rows = list(rows)
    small = sum(len(repr(row)) for row in rows) <= BROADCAST_MAX_BYTES
    frame = spark.createDataFrame(rows, schema)
    return F.broadcast(frame) if small else frame


def category_dimension(spark: SparkSession) -> DataFrame:
    return inline_dimension(spark, CATEGORY_NAMES.items(), "category_id int, category_name string")


def table_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, column names, partitions, and how many of these hold rows."""
    partition = F.spark_partition_id()
    return df.select(partition.alias("p")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.lit(df.rdd.getNumPartitions()).alias("n_partitions"),
        F.count_distinct("p").alias("n_filled_partitions"),
    )
