"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as contract
from sparkscope import runtime
from sparkscope.operators import clean, rollup
from sparkscope.plans import clustering
from sparkscope.plans.adapters import grouped_parts, raw_snapshots, table
from sparkscope.plans.prepare import PREDICTORS, prepare
from sparkscope.sources import results, tables

SF = "/root/testdata/sf0.001"
STUDIES = {"lr_study", "svc_study", "rf_study", "cv_accuracy", "rf_importance", "rf_importance_total", "pipeline_stages",
           "model_roundtrip", "lr_separable", "svc_separable", "rf_separable", "composite_key_split", "elbow", "kmeans_sweep",
           "wcss_summary", "saved_study_comparison", "elbow_groups", "wcss_groups", "saved_clusters"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.CORPUS_QUERIES) - STUDIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_dedup_is_cut_before_the_shuffle(spark):
    text = plan(contract.queries()["dedup_keyed"](spark, SF))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_small_dimension_is_broadcast_by_size(spark):
    text = plan(contract.queries()["dim_lookup"](spark, SF))
    assert "BroadcastHashJoin" in text and "LeftOuter" in text


def test_large_dimension_is_shuffled(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(contract.queries()["dim_lookup"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_literal_dimension_is_broadcast_in_the_static_plan(spark):
    text = plan(prepare(raw_snapshots(spark, SF), tables.category_dimension(spark)))
    assert "BroadcastHashJoin [category_id" in text and "hashpartitioning(category_id#" not in text.replace("hashpartitioning(video_id", "")


def test_preparation_starts_no_job(spark):
    raw = raw_snapshots(spark, SF)  # reading the files' schema is a job
    spark.sparkContext.setJobGroup("build", "building only")
    try:
        prepare(raw, tables.category_dimension(spark))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setJobGroup("default", "")


def test_assigning_clusters_does_not_shuffle(spark):
    assigned = clustering.assign_clusters(grouped_parts(spark, SF), "video_id", PREDICTORS, 4)
    assert "Exchange" not in plan(assigned)


def test_csv_header_in_another_order_is_an_error(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("views,id,text\n5,1,a\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(path), "id int, text string, views double").collect()


def test_split_csv_scan_does_not_misread_a_line_break(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,text,views\n1,"two\nlines",5\n', encoding="utf-8")
    schema = "id int, text string, views double"
    assert tables.read_csv(spark, str(path), schema).collect()[0].views == 5
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path), schema, multi_line=False).collect()


def test_scratch_tables_are_deleted(spark):
    with runtime.scratch(spark):
        path = runtime.materialize(spark.range(5)).inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_class_filter_does_not_shuffle_the_rows(spark):
    text = plan(contract.queries()["min_class_filter"](spark, SF))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "hashpartitioning" not in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(rollup.peak_rollup(table(spark, SF, "lineitem"), ["l_partkey"], ["l_quantity"]))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    required = plan(clean.require(table(spark, SF, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"]))
    assert "IsNotNull(o_totalprice)" in required


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,text,views\n1,"a ""quoted"" word",5\n2,"two\nlines",\n', encoding="utf-8")
    schema = "id int, text string, views double"
    rows = tables.read_csv(spark, str(path), schema).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'a "quoted" word', 5.0), (2, "two\nlines", None)]
    inferred = tables.read_csv(spark, str(path), None, multi_line=True)
    assert dict(inferred.dtypes) == {"id": "int", "text": "string", "views": "int"}


def test_profile(spark):
    r = tables.table_profile(spark.range(10).repartition(2).toDF("a")).first()
    assert (r.n_rows, r.n_columns, r.column_names, r.n_partitions) == (10, 1, "a", 2)


def test_saved_results_are_not_overwritten_by_default(spark, tmp_path):
    frame = spark.range(3)
    results.save_results({"t": frame}, str(tmp_path))
    assert results.load_results(spark, str(tmp_path), ["t"])["t"].count() == 3
    with pytest.raises(Exception):
        results.save_results({"t": frame}, str(tmp_path))
    results.save_results({"t": spark.range(5)}, str(tmp_path), mode="overwrite")
    assert results.load_results(spark, str(tmp_path), ["t"])["t"].count() == 5
