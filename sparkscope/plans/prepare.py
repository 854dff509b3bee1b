"""Preparation: raw snapshots -> one modelling row per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.functions.columns import clean_names, coerce, duration_seconds
from sparkscope.operators.clean import dedup_keyed, require
from sparkscope.operators.quantiles import SKETCH_ACCURACY, impute_median
from sparkscope.operators.rollup import add_ratios, lookup, peak_rollup
from sparkscope.runtime import materialize

# Types every snapshot column is forced to.
SNAPSHOT_TYPES = {
    "view_count": "double",
    "likes": "double",
    "dislikes": "double",
    "comment_count": "double",
    "published_at": "date",
    "trending_date": "date",
    "category_id": "double",
    "duration": "string",
}
# Fixed value: category id given to rows without one.
UNKNOWN_CATEGORY = -1
SNAPSHOT_KEY = ("video_id", "trending_date")
PEAK_COLUMNS = ("view_count", "likes", "comment_count", "duration_seconds")
RATES = {"like_rate": ("likes", "view_count"), "comment_rate": ("comment_count", "view_count")}
# Predictors of the studies.
PREDICTORS = ("view_count", "likes", "comment_count", "duration_seconds", "like_rate", "comment_rate")
EXTENDED_PREDICTORS = (*PREDICTORS, "trending_count")
# Columns counted by the missing-value audit, and whether zero counts as missing.
AUDIT = {
    "video_id": False, "title": False, "channel_id": False, "channel_title": False, "category_id": False,
    "view_count": True, "likes": False, "dislikes": True, "comment_count": False, "published_at": False,
    "trending_date": False, "duration": False,
}
# Missing values replaced by the median; only a zero view count is missing too.
IMPUTED = {"view_count": True, "likes": False, "comment_count": False}


def snapshot_order() -> list[Column]:
    """Which of several snapshots of one key is kept: the most viewed first."""
    return [
        F.col("view_count").desc_nulls_last(),
        F.col("likes").desc_nulls_last(),
        F.col("comment_count").desc_nulls_last(),
        F.col("duration").asc_nulls_last(),
        F.col("category_id").asc_nulls_last(),
        F.col("published_at").asc_nulls_last(),
    ]


def typed_snapshots(raw: DataFrame) -> DataFrame:
    """Snake-case names and forced types; unparsable values become null."""
    df = clean_names(raw)
    return coerce(df, {name: kind for name, kind in SNAPSHOT_TYPES.items() if name in df.columns})


def clean_snapshots(raw: DataFrame, order: Sequence[Column] | None = None, include_days: bool = False,
                    accuracy: int | None = SKETCH_ACCURACY) -> DataFrame:
    """One complete row per item and day.

    Rows without a key are dropped before the duplicates are resolved, so null keys
    never meet in one task. In the default order views sort first and nulls last, so
    a row without views is kept only if its key has no other and may go beforehand
    too; with any other ``order`` it goes afterwards.

    With the default sketch for the medians nothing runs before the result is asked
    for. Exact medians (``accuracy=None``) take several passes, so the deduplicated,
    narrow table is written once for them.
    """
    needed = ["video_id", "category_id", "view_count", "likes", "comment_count", "duration", "published_at",
              "trending_date"]
    before = [*SNAPSHOT_KEY] if order else [*SNAPSHOT_KEY, "view_count"]
    snapshots = require(typed_snapshots(raw).select(*needed), before)
    unique = require(dedup_keyed(snapshots, SNAPSHOT_KEY, order or snapshot_order()), ["view_count"])
    if accuracy is None:
        unique = materialize(unique, "snapshots")
    filled = impute_median(unique, IMPUTED, accuracy=accuracy)
    return filled.withColumns({
        "category_id": F.coalesce(F.col("category_id"), F.lit(UNKNOWN_CATEGORY)).cast("int"),
        "duration": F.coalesce(F.col("duration"), F.lit("PT0S")),
        "duration_seconds": duration_seconds("duration", include_days),
    }).select("video_id", "category_id", "view_count", "likes", "comment_count", "duration", "duration_seconds",
              "published_at", "trending_date")


def prepare(raw: DataFrame, categories: DataFrame, include_days: bool = False,
            accuracy: int | None = SKETCH_ACCURACY) -> DataFrame:
    """Raw snapshots to peak rows with category name and engagement rates.

    The category name depends on the id alone, so it is looked up after the
    rollup, on the smaller table.
    """
    clean = clean_snapshots(raw, include_days=include_days, accuracy=accuracy)
    peaks = peak_rollup(clean, ["video_id", "category_id"], PEAK_COLUMNS)
    named = lookup(peaks, categories, "category_id")
    return add_ratios(named, RATES).select(
        "video_id", "category_id", "category_name", *PEAK_COLUMNS, "trending_count", *RATES)
