"""Hand-computed results for preparation and metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkscope.operators import clean, evaluate, quantiles
from sparkscope.plans import prepare as prep
from sparkscope.sources.tables import inline_dimension

RAW_SCHEMA = ("video_id string, categoryId string, trending_date string, view_count double, likes double, "
              "dislikes double, comment_count double, duration string, publishedAt string, title string, "
              "channelId string, channelTitle string")
PUBLISHED = "2023-12-31T10:00:00Z"


def row(video, category, date, views, likes, dislikes, comments, duration):
    return (video, category, date, views, likes, dislikes, comments, duration, PUBLISHED, "t", "c", "ct")


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame([
        row("v1", "10", "2024-01-01", 100.0, 10.0, 0.0, 5.0, "PT1H2M3S"),
        row("v1", "10", "2024-01-02", 300.0, 9.0, None, 8.0, "PT1H2M3S"),
        row("v1", "10", "2024-01-02", 290.0, 12.0, 3.0, 7.0, "PT1H2M3S"),
        row("v2", "23", "2024-01-01", 0.0, None, 0.0, 1.0, "PT45S"),
        row("v3", "34", "2024-01-01", 50.0, 5.0, 1.0, None, None),
        row("v4", None, "2024-01-01", 200.0, 20.0, 0.0, 4.0, "P1DT2H"),
        row("v5", "99", "2024-01-01", 80.0, 8.0, 0.0, 2.0, "PT10M"),
        row(None, "10", "2024-01-01", 10.0, 1.0, 0.0, 1.0, "PT1S"),
        row("v6", "10", None, 10.0, 1.0, 0.0, 1.0, "PT1S"),
        row("v7", "10", "2024-01-03", None, 1.0, 0.0, 1.0, "PT1S"),
        row("v8", "24", "2024-01-01", 500.0, 50.0, 0.0, 6.0, ""),
    ], RAW_SCHEMA)


@pytest.fixture()
def categories(spark):
    return inline_dimension(
        spark, [(10, "Music"), (23, "Comedy"), (34, "Comedy"), (24, "Entertainment"), (-1, "Unknown")],
        "category_id int, category_name string")


def test_prepare(raw, categories):
    rows = {r.video_id: r for r in prep.prepare(raw, categories).collect()}
    expected = {
        "v1": (10, "Music", 300, 10, 8, 3723, 2, 0.033333, 0.026667),
        "v2": (23, "Comedy", 100, 9, 1, 45, 1, 0.09, 0.01),
        "v3": (34, "Comedy", 50, 5, 4, 0, 1, 0.1, 0.08),
        "v4": (-1, "Unknown", 200, 20, 4, 7200, 1, 0.1, 0.02),
        "v5": (99, None, 80, 8, 2, 600, 1, 0.1, 0.025),
        "v8": (24, "Entertainment", 500, 50, 6, 0, 1, 0.1, 0.012),
    }
    assert rows.keys() == expected.keys()
    for video, values in expected.items():
        got = rows[video]
        assert tuple(got)[1:8] == values[:7], video
        assert (round(got.like_rate, 6), round(got.comment_rate, 6)) == values[7:], video


def test_prepare_with_sketch_median_agrees_on_small_data(raw, categories):
    exact = prep.prepare(raw, categories).collect()
    sketch = prep.prepare(raw, categories, accuracy=10_000).collect()
    assert sorted(map(str, exact)) == sorted(map(str, sketch))


def test_clean_types_and_unknown_category(raw):
    clean_rows = prep.clean_snapshots(raw)
    assert dict(clean_rows.dtypes) == {
        "video_id": "string", "category_id": "int", "view_count": "double", "likes": "double",
        "comment_count": "double", "duration": "string", "duration_seconds": "int", "published_at": "date",
        "trending_date": "date"}
    kept = {(r.video_id, r.trending_date): r for r in clean_rows.collect()}
    assert len(kept) == 7
    assert kept["v1", dt.date(2024, 1, 2)].view_count == 300.0
    assert kept["v3", dt.date(2024, 1, 1)].duration == "PT0S"


def test_days_counted_on_request(raw):
    rows = {r.video_id: r.duration_seconds for r in prep.clean_snapshots(raw, include_days=True).collect()}
    assert rows["v4"] == 86400 + 7200


def test_audit_after_dedup(raw):
    typed = prep.typed_snapshots(raw)
    unique = clean.dedup_keyed(typed, prep.SNAPSHOT_KEY, prep.snapshot_order())
    assert unique.count() == 10
    audit = clean.missing_audit(unique, prep.AUDIT).first().asDict()
    assert audit == {
        "video_id_na": 1, "title_na": 0, "channel_id_na": 0, "channel_title_na": 0, "category_id_na": 1,
        "view_count_na": 2, "likes_na": 1, "dislikes_na": 9, "comment_count_na": 1, "published_at_na": 0,
        "trending_date_na": 1, "duration_na": 1}
    ratio = clean.missing_ratio(unique, "dislikes", zero_is_missing=True).first()
    assert (ratio.total, ratio.dislikes_present, ratio.dislikes_missing, ratio.missing_percentage) == (10, 1, 9, 90.0)


def test_medians(raw):
    unique = clean.dedup_keyed(prep.typed_snapshots(raw), prep.SNAPSHOT_KEY, prep.snapshot_order())
    required = clean.require(unique, ["video_id", "trending_date", "view_count"])
    medians = quantiles.exact_quantiles(required, ["view_count", "likes", "comment_count"], [0.5])
    assert {r.column: r.value for r in medians.collect()} == {"view_count": 100, "likes": 9, "comment_count": 4}


def test_impute_can_leave_zeros_out_of_the_median(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (4.0,), (6.0,)], "x double")
    assert [r.x for r in quantiles.impute_median(df, {"x": True}).orderBy("x").collect()] == [0, 0, 0, 4, 6]
    filled = quantiles.impute_median(df, {"x": True}, exclude_zero=True)
    assert [r.x for r in filled.orderBy("x").collect()] == [4, 4, 4, 4, 6]


PAIRS = [("A", "A")] * 3 + [("A", "B")] + [("B", "B")] * 2 + [("B", "A")] + [("C", "A")]


def test_class_metrics(spark):
    predictions = spark.createDataFrame(PAIRS, "actual string, predicted string")
    counts = evaluate.confusion_counts(predictions, "actual", "predicted")
    per_class = evaluate.class_metrics(counts)
    got = {r["class"]: tuple(round(r[m], 6) for m in ("precision", "recall", "f1")) for r in per_class.collect()}
    assert got == {"A": (0.6, 0.75, 0.666667), "B": (0.666667, 0.666667, 0.666667), "C": (0, 0, 0)}
    macro = evaluate.macro_metrics(per_class).first()
    assert [round(x, 6) for x in (macro.accuracy, macro.macro_precision, macro.macro_recall, macro.macro_f1)] == [
        0.625, 0.422222, 0.472222, 0.444444]


def test_confusion_matrix_keeps_empty_cells(spark):
    predictions = spark.createDataFrame(PAIRS, "actual string, predicted string")
    matrix = evaluate.confusion_matrix(predictions, "actual", "predicted")
    cells = {(r.predicted, r.actual): r.n for r in matrix.collect()}
    assert cells == {("A", "A"): 3, ("A", "B"): 1, ("A", "C"): 1, ("B", "A"): 1, ("B", "B"): 2, ("B", "C"): 0}
    again = evaluate.class_metrics(matrix).filter(F.col("class") == "C").first()
    assert (again.precision, again.actual_n, again.predicted_n) == (0.0, 1, 0)
