"""Parallel CSV scan, stored sketches, sorted quantiles, wide correlation, class prefilter, parallel jobs."""

import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkscope.operators import clean, models, quantiles, sketches, stats
from sparkscope.operators.sorted_quantiles import sorted_quantiles
from sparkscope.runtime import in_parallel
from sparkscope.sources.split_csv import read_csv_splits, text_lines
from sparkscope.sources.tables import read_csv

TEXTS = ['plain', 'a "quoted"\r\nline\n\n"', '"', '""', '\n', '\n\n\n', 'comma, "and\nmore', 'é\n"', 'x' * 900 + '\n' * 40 + '"' * 7, None, 'last']


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def csv_rows(seed, n=300):
    rng = random.Random(seed)
    return [(i, rng.choice(TEXTS), rng.choice(["en", None, "a\nb"]), rng.choice([None, 1.5, -2.0])) for i in range(n)]


SCHEMA = "id bigint, text string, lang string, value double"


@pytest.mark.parametrize("seed, files", [(1, 1), (2, 3)])
def test_csv_splits_equal_one_task(spark, small_splits, tmp_path, seed, files):
    path = str(tmp_path / "csv")
    writer = spark.createDataFrame(csv_rows(seed), SCHEMA).repartition(files, "id").write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    got = read_csv_splits(spark, path, SCHEMA)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, read_csv(spark, path, SCHEMA).collect()))
    assert got.count() == 300 and text_lines(spark, path).rdd.getNumPartitions() > 20 * files


def test_csv_splits_line_ends_and_faults(spark, tmp_path):
    def file(name, content):
        (tmp_path / name).write_bytes(content)
        return str(tmp_path / name)

    two = "a string, b string"
    windows = file("windows.csv", b'a,b\r\n1,"x\r\ny"\r\n\r\n2,\r\n')
    assert sorted(map(tuple, read_csv_splits(spark, windows, two).collect())) == [("1", "x\r\ny"), ("2", None)]
    bare = file("bare.csv", b'1,"x"\n2,y')
    assert sorted(map(tuple, read_csv_splits(spark, bare, two, header=False).collect())) == [("1", "x"), ("2", "y")]
    assert read_csv_splits(spark, file("empty.csv", b""), two).count() == 0
    assert read_csv_splits(spark, file("names.csv", b"a,b\n"), two).count() == 0
    with pytest.raises(Exception, match="differs from the schema"):
        read_csv_splits(spark, file("swapped.csv", b"b,a\n1,2\n"), two)
    with pytest.raises(ValueError, match="never closed"):
        read_csv_splits(spark, file("open.csv", b'a,b\n1,"2\n'), two)


# --- parallel jobs ----------------------------------------------------------------------

def test_jobs_do_not_share_properties(spark):
    spark.sparkContext.setLocalProperty("caller", "kept")
    everyone = threading.Barrier(4, timeout=60)

    def job(i):
        spark.sparkContext.setLocalProperty("own", str(i))
        everyone.wait()  # all four have set theirs
        seen = spark.sparkContext.getLocalProperty("own"), spark.sparkContext.getLocalProperty("caller")
        everyone.wait()
        return seen, spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    found = in_parallel(spark, job, range(4), width=4)
    assert [x[0] for x in found] == [(str(i), "kept") for i in range(4)]
    assert len({x[1] for x in found}) == 4
    assert spark.sparkContext.getLocalProperty("own") is None
    spark.sparkContext.setLocalProperty("caller", None)


def test_binary_models_run_one_after_the_other():
    assert models.SVM_SCENARIOS[0].estimator().getParallelism() == 1


def test_deep_forest_equals_one_without_cache(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.random(), rng.random(), float(i % 7), f"c{int(3 * rng.random() ** 2)}") for i in range(800)]
    data = spark.createDataFrame(rows, "x double, y double, z double, label_name string").repartition(4).cache()
    index = models.fit_label_index(data, "label_name")
    deep = models.deep_forest("deep", 12, 10, memory_mb=1, checkpoint_every=2)
    plain = models.ForestScenario("plain", 12, 10, 1, 32)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    trees = [models.classifier_pipeline(s, ["x", "y", "z"], index).fit(data).stages[-1].toDebugString.split("\n", 1)[1] for s in (deep, plain)]
    assert trees[0] == trees[1] and "depth" not in trees[0][:5]


# --- sketches ---------------------------------------------------------------------------

VALUES = "grp string, x double, y double"


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([0.0, 0.0, rng.gauss(5, 40), None, float("nan")]), rng.random() * 10 ** rng.randrange(6))
            for _ in range(6000)] + [("single", 1.0, None), ("nothing", None, None)]
    return spark.createDataFrame(rows, VALUES).repartition(7).cache()


def test_merged_summaries_equal_direct_ones(values):
    parts = sketches.summaries(values.withColumn("part", F.floor(F.col("y")) % 9), ["x", "y"], ["grp", "part"])
    merged = sketches.describe_summaries(sketches.merge_summaries(parts, ["grp"]), ["grp"]).collect()
    direct = {(r.grp, r.column): r for r in sketches.describe_summaries(sketches.summaries(values, ["x", "y"], ["grp"]), ["grp"]).collect()}
    assert {(r.grp, r.column) for r in merged} == set(direct) and ("nothing", "x") not in direct and ("single", "y") not in direct
    for r in merged:
        want = direct[r.grp, r.column]
        assert (r.n, r.min, r.max) == (want.n, want.min, want.max)
        assert r.mean == pytest.approx(want.mean, rel=1e-9) and (r.sd is None) == (want.sd is None)
        assert r.sd is None or r.sd == pytest.approx(want.sd, rel=1e-9)
    found = sketches.summary_quantiles(sketches.merge_summaries(parts), [0.05, 0.5, 0.95])
    assert quantiles.rank_errors(values, found).agg(F.max("rank_error")).first()[0] <= 2 * sketches.kll_rank_error()
    shares = {r.value: r.share for r in sketches.summary_ranks(sketches.merge_summaries(parts), [1e9, -1e9]).where("column = 'y'").collect()}
    assert shares == {1e9: 1.0, -1e9: 0.0}
    assert sketches.summaries(values.limit(0), ["x"]).count() == 0


@pytest.mark.parametrize("accuracy", [4, 10_000])
def test_refined_quantiles_are_exact(values, accuracy):
    for by in ([], ["grp"]):
        want = quantiles.exact_quantiles(values, ["x", "y"], [0.0, 0.1, 0.5, 1.0], by)
        found = quantiles.refined_quantiles(values, ["x", "y"], [0.0, 0.1, 0.5, 1.0], by, accuracy, max_ranked=50)
        assert Counter(found.collect()) == Counter(want.collect())
    assert quantiles.refined_quantiles(values.limit(0), ["x"], [0.5]).count() == 0


def test_quantiles_sketch_returns_the_quantiles(spark):
    from sparkscope.plans import catalog
    assert {"column", "p", "value", "n", "within"} == set(catalog.quantiles_sketch(spark, "/root/testdata/sf0.001").columns)


def test_rank_errors_find_wrong_quantiles(values):
    exact = quantiles.exact_quantiles(values, ["x", "y"], [0.1, 0.5], ["grp"])
    assert quantiles.rank_errors(values, exact, ["grp"]).where("rank_error <> 0").count() == 0
    wrong = exact.withColumn("value", F.col("value") + 1e7)
    assert quantiles.rank_errors(values, wrong, ["grp"]).where("rank_error < 0.4").count() == 0


def test_distinct_sketches_merge(values):
    parts = sketches.distinct_sketches(values, ["x", "y"], ["grp"]).withColumn("one", F.lit(1))
    merged = {r.column: r.n_distinct for r in sketches.distinct_estimates(sketches.merge_distinct(parts)).collect()}
    for c, n in merged.items():
        exact = values.agg(F.count_distinct(c)).first()[0]
        assert abs(n - exact) <= 0.05 * exact


# --- many groups, many columns, many classes --------------------------------------------

@pytest.mark.parametrize("by, interpolate, parts", [
    ([], True, 5), (["grp"], False, 40), (["grp"], True, 1), (["grp", "bucket"], False, 5), (["grp", "bucket"], True, 40)])
def test_sorted_quantiles(values, by, interpolate, parts):
    frame = values.withColumn("bucket", (F.col("y") * 7 % 50).cast("int"))
    args = (["x", "y"], [0.0, 0.1, 0.5, 1.0], by, interpolate)
    got = sorted_quantiles(frame, *args, parts=parts)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, quantiles.exact_quantiles(frame, *args).collect()))


def test_sorted_quantiles_spread_a_hot_group(spark):
    """A group with most of the rows, a third of them one value, is sorted by many tasks."""
    frame = spark.range(30_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("grp"),
                                       F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"))
    got = sorted_quantiles(frame, ["x"], [0.5], ["grp"], parts=16).where("grp = -1").collect()
    own = sorted(0 if i % 3 == 0 else i for i in range(30_000) if i % 10)
    assert [r.value for r in got] == [own[-(-len(own) // 2) - 1]]
    ordered = frame.groupBy("grp", "x").count().repartitionByRange(16, "grp", "x")
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 16
    assert sorted_quantiles(frame.limit(0), ["x"], [0.5], ["grp"]).count() == 0


def test_correlation_wide(spark):
    rng = random.Random(2)
    names = [f"c{i}" for i in range(60)]
    rows = [[1e9 + rng.random() if i < 2 else 7.0 if i == 5 else None if i == 9 and n % 4 == 0 else rng.gauss(0, 1 + i) for i in range(60)]
            for n in range(200)]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    got = {(r.var1, r.var2): r.value for r in stats.correlation_wide(frame, names).collect()}
    want = {(r.var1, r.var2): r.value for r in stats.correlation_long(frame, names[:12]).collect()}
    assert len(got) == 3600 and got["c5", "c7"] is None and got["c5", "c5"] is None
    complete = stats.correlation_long(clean.complete_cases(frame, names), names[:12]).collect()
    for r in complete:
        assert (got[r.var1, r.var2] is None) == (r.value is None)
        assert r.value is None or got[r.var1, r.var2] == pytest.approx(r.value, abs=1e-5 if {r.var1, r.var2} & {"c0", "c1"} else 1e-9)
    assert len(want) == 144
    assert {r.value for r in stats.correlation_wide(frame.limit(1), ["c1", "c2"]).collect()} == {None}


def test_frequent_among_many(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(i, rng.choice(["hot"] * 500 + [None] * 100 + [f"k{j}" for j in range(900)])) for i in range(5000)],
                                  "id bigint, cls string").repartition(4)
    for buckets in (1, 64, 1 << 20):
        got = clean.frequent_among_many(frame, "cls", 4, buckets)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, clean.frequent_classes(frame, "cls", 4).collect()))
    assert clean.frequent_among_many(frame.limit(0), "cls", 4).count() == 0
