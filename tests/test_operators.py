"""Operators against brute force, on skewed and awkward inputs."""

import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkscope import runtime
from sparkscope.functions import columns as C
from sparkscope.operators import clean, distributions, quantiles, reshape, rollup, split, stats

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def discrete(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(len(ordered) * p), 1) - 1]


def check_quantiles(df, by, data, max_ranked):
    for interpolate in (False, True):
        found = quantiles.exact_quantiles(df, ["x"], PROBS, by, interpolate, max_ranked).collect()
        got = {((r[by[0]] if by else 0), r.p): r.value for r in found}
        assert len(got) == len(found) == len(PROBS) * len(data)
        for group, values in data.items():
            for p in PROBS:
                want = float(np.quantile(values, p)) if interpolate else discrete(values, p)
                assert got[group, p] == pytest.approx(want, rel=1e-12, abs=1e-300), (group, p, interpolate)


@pytest.mark.parametrize("max_ranked", [5, 1_000_000])
def test_quantiles_of_skewed_groups(spark, max_ranked):
    rng = np.random.default_rng(1)
    data = {
        "hot": np.concatenate([np.full(3000, 7.5), rng.lognormal(8, 3, 2000)]).tolist(),
        "close": (1.7e9 + rng.random(500) * 1e-3).tolist(),
        "mixed": rng.normal(0, 1e-7, 300).tolist() + [-1e15, 1e15, 0.0, 0.0],
        None: [4.0, 1.0, 3.0, 2.0],
        "one": [-2.0],
    }
    rows = [(g, v) for g, values in data.items() for v in values] + [("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    check_quantiles(df, ["g"], data, max_ranked)
    everything = {0: [v for values in data.values() for v in values]}
    check_quantiles(df, [], everything, max_ranked)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_subnormal=False), min_size=1, max_size=60))
def test_quantiles_of_arbitrary_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles.exact_quantiles(df, ["x"], PROBS, max_ranked=3).collect()
    assert {r.p: r.value for r in found} == {p: discrete(values, p) for p in PROBS}


def test_quantiles_of_even_group(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "x double")
    found = {r.p: r.value for r in quantiles.exact_quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert found == {0.25: 1.0, 0.5: 2.0}


def test_sketch_stays_within_its_rank_error(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("x"))
    for r in quantiles.approx_quantiles(df, ["x"], [0.25, 0.5, 0.75], accuracy=1000).collect():
        rank = r.value + 1
        assert abs(rank - r.p * 100_000) <= 100_000 / 1000


@pytest.mark.parametrize("max_bytes", [0, 1000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_summary_join_gives_the_same_either_way(spark, max_bytes, how):
    detail = spark.createDataFrame(
        [("hot", i) for i in range(900)] + [(None, i) for i in range(50)] + [("rare", 1), ("absent", 2)],
        "k string, v int").repartition(6)
    summary = spark.createDataFrame([("hot", 1.0), (None, 2.0), ("rare", 3.0)], "k string, s double")
    joined = runtime.join_summary(detail, summary, ["k"], how, max_bytes=max_bytes)
    counts = {r.k: r["count"] for r in joined.groupBy("k").count().collect()}
    assert counts == {"hot": 900, None: 50, "rare": 1, **({"absent": 1} if how == "left" else {})}
    if how == "inner":
        assert {(r.k, r.s) for r in joined.select("k", "s").distinct().collect()} == {
            ("hot", 1.0), (None, 2.0), ("rare", 3.0)}


def test_summary_join_switches_plan_on_measured_size(spark):
    detail = spark.range(100).select((F.col("id") % 3).cast("string").alias("k"))
    summary = spark.createDataFrame([("0", 1.0), ("1" * 500, 2.0)], "k string, s double")
    assert summary.agg(runtime.total_bytes(summary)).first()[0] == 501 + 2 * 2 * 16
    small = runtime.join_summary(detail, summary, ["k"])
    large = runtime.join_summary(detail, summary, ["k"], max_bytes=500)
    plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (small, large)]
    assert "broadcast" in plans[0]
    assert "broadcast" not in plans[1] and "explode" not in plans[1]
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_persisted_frames_are_released(spark):
    frame = spark.range(10).select((F.col("id") + 1).alias("x"))
    with pytest.raises(RuntimeError):
        with runtime.persisted(frame) as held:
            assert held.count() == 10 and held.storageLevel.useMemory and held.storageLevel.useDisk
            raise RuntimeError
    assert not frame.storageLevel.useMemory


def test_shared_folder_is_the_configured_one(spark):
    assert runtime.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_written_tables_can_be_discarded(spark, monkeypatch):
    monkeypatch.setattr(runtime, "_written", {})
    table = runtime.materialize(spark.range(3))
    assert table.count() == 3
    assert runtime.discard_written(spark) == 1 and runtime.discard_written(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(*table.inputFiles()).count()


def test_dedup_keeps_first_in_order_even_for_a_hot_key(spark):
    rows = [(1, i % 977, i) for i in range(5000)] + [(2, 5, 1), (2, 5, 0)]
    df = spark.createDataFrame(rows, "k int, v int, id int").repartition(7)
    kept = clean.dedup_keyed(df, ["k"], [F.desc("v"), F.asc("id")])
    assert {tuple(r) for r in kept.collect()} == {(1, 976, 976), (2, 5, 0)}


def test_frequent_classes_threshold_is_inclusive_and_drops_null(spark):
    rows = [("a",)] * 50 + [("b",)] * 49 + [(None,)] * 60
    df = spark.createDataFrame(rows, "c string")
    assert {r.c for r in clean.frequent_classes(df, "c", 50).collect()} == {"a"}


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0), (None, 1.0, 5.0)],
                               "x double, y double, z double")
    cells = {(r.var1, r.var2): r.value for r in stats.correlation_long(df, ["x", "y", "z"]).collect()}
    assert len(cells) == 9
    assert cells["x", "z"] is None and cells["z", "z"] is None
    assert cells["x", "x"] == pytest.approx(1.0)
    assert cells["x", "y"] == cells["y", "x"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])


def test_redundancy_screen(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2 + F.col("id") % 2).alias("b"),
        (F.col("id") * 37 % 101).alias("c"))
    flagged = {(r.candidate, r.kept): r.redundant for r in stats.redundant_features(df, ["b"], ["a", "c"]).collect()}
    assert flagged == {("b", "a"): True, ("b", "c"): False}


def test_describe(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    r = stats.describe_numeric(df, ["x"]).first()
    assert (r["min"], r.q1, r["median"], r.q3, r["max"]) == (1.0, 1.0, 3.0, 5.0, 9.0)
    assert r["mean"] == pytest.approx(statistics.mean(values)) and r.sd == pytest.approx(statistics.stdev(values))


def test_histogram_counts_everything_once(spark):
    df = spark.createDataFrame([(0.0,), (-3.0,), (None,), (1.0,), (10.0,), (100.0,), (100.0,)], "x double")
    rows = distributions.log_histogram(df, ["x"], bins=4).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 0, 1, 2]
    assert {r.n_dropped for r in rows} == {3}
    assert rows[-1].log_hi == pytest.approx(2.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(10.0,)] * 3, "x double")
    assert [r.n for r in distributions.log_histogram(df, ["x"], bins=3).orderBy("bin").collect()] == [3, 0, 0]


def test_box_statistics(spark):
    df = spark.createDataFrame([(10.0 ** e, "g") for e in (0, 1, 1, 2, 2, 3, 9)] + [(0.0, "g")], "x double, g string")
    for by in ([], ["g"]):
        r = distributions.box_stats(df, ["x"], by).first()
        assert (r.q1, r["median"], r.q3) == pytest.approx((1.0, 2.0, 2.5))
        assert (r.whisker_lo, r.whisker_hi) == pytest.approx((0.0, 3.0))
        assert (r.n, r.n_outliers, r.n_dropped) == (7, 1, 1)


def test_pair_density_covers_positive_points(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"), (F.col("id") % 10).alias("y"))
    assert distributions.pair_density(df, [("x", "y")]).agg(F.sum("n")).first()[0] == 900


def test_pair_density_per_group(spark):
    df = spark.createDataFrame([("a", 10.0, 10.0), ("a", 11.0, 10.0), ("b", 10.0, 1.0), ("b", 0.0, 1.0)],
                               "g string, x double, y double")
    rows = {(r.g, r.x_cell, r.y_cell): r.n for r in distributions.pair_density(df, [("x", "y")], 0.5, ["g"]).collect()}
    assert rows == {("a", 2, 2): 2, ("b", 2, 0): 1}


def test_ratios_need_a_positive_denominator(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0), (3.0, -1.0)], "a double, b double")
    assert [tuple(r) for r in rollup.add_ratios(df, {"r": ("a", "b")}).collect()] == [(1.0, 4.0, 0.25)]


def test_split_shares_folds_and_independence(spark):
    df = spark.range(30_000).select("id", split.hash_split("id", {"training": 0.8, "test": 0.2}).alias("part"),
                                    split.fold_number("id", 3).alias("fold"))
    counts = {(r.part, r.fold): r["count"] for r in df.groupBy("part", "fold").count().collect()}
    for (part, _), n in counts.items():
        assert n == pytest.approx(30_000 * (0.8 if part == "training" else 0.2) / 3, rel=0.08)
    assert len(counts) == 6


def test_random_split_does_not_depend_on_layout(spark):
    df = spark.range(2000)
    parts = [split.random_split(frame, "id", [0.8, 0.2], 4)[1] for frame in (df.repartition(2), df.repartition(9))]
    first, second = [sorted(r.id for r in part.collect()) for part in parts]
    assert first == second and 0 < len(first) < 800


def test_best_row_prefers_the_first_on_ties(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.4), (2, 0.5)], "ordinal int, f1 double")
    assert reshape.best_row(df, "f1", "ordinal").first().ordinal == 2


def test_stack_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert {tuple(r) for r in reshape.stack([a, b]).collect()} == {(1, None), (2, "q")}


@pytest.mark.parametrize("text, seconds, with_days", [
    ("PT1H23M45S", 5025, 5025), ("PT59S", 59, 59), ("PT0S", 0, 0), ("P0D", 0, 0), ("P1DT2H", 7200, 93600),
    ("P3M", 180, 0), ("", 0, 0), (None, 0, 0), ("P1W", 0, 604800), ("P2DT10M", 600, 173400),
])
def test_durations(spark, text, seconds, with_days):
    df = spark.createDataFrame([(text,)], "d string")
    assert tuple(df.select(C.duration_seconds("d"), C.duration_seconds("d", True)).first()) == (seconds, with_days)


def test_coercion_never_fails(spark):
    df = spark.createDataFrame([("1", "x", "2024-02-30"), ("", "", ""), (None, None, "2024-02-29T23:59:59Z")],
                               "a string, b string, c string")
    rows = C.coerce(df, {"a": "double", "b": "int", "c": "date"}).collect()
    assert [r.a for r in rows] == [1.0, None, None]
    assert [r.b for r in rows] == [None] * 3
    assert [str(r.c) for r in rows] == ["None", "None", "2024-02-29"]


@pytest.mark.parametrize("name, snake", [
    ("publishedAt", "published_at"), ("categoryId", "category_id"), ("view_count", "view_count"),
    ("HTTPServer2Id", "http_server2_id"), ("Like %", "like_percent"), ("2nd", "x2nd"), ("...", "x"),
])
def test_snake_case(name, snake):
    assert C.snake_case(name) == snake


def test_missing_never_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.0,)], "x double")
    assert [tuple(r) for r in df.select(C.is_missing("x"), C.is_missing("x", True)).collect()] == [
        (True, True), (False, True), (False, False)]
