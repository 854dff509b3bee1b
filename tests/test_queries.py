"""Every registered query against its SQL, and row sanity for those without one."""

import pytest

import __spark_entry__ as contract
from sparkscope.plans import catalog
from tests.oracle import duck, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
# The corpus operators have tests of their own; the library's must pass without them.
QUERIES = {name: query for name, query in contract.queries().items() if name not in contract.CORPUS_QUERIES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
# Queries whose classes are too small at the smallest scale; they are compared at the next.
LARGER = {"lr_separable", "svc_separable", "rf_separable", "saved_study_comparison", "pipeline_stages", "rf_importance_total",
          "composite_key_split"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(SQL) - LARGER))
def test_matches_sql(spark, connection, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connection, SQL[name])


@pytest.mark.parametrize("name", sorted(LARGER))
def test_matches_sql_at_the_next_scale(spark, name):
    larger = SF.replace("0.001", "0.01")
    assert spark_rows(QUERIES[name](spark, larger)) == sql_rows(duck(larger), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name, monkeypatch):
    monkeypatch.setattr(catalog, "MIN_SAMPLES", 25)
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "video_id", "category_id", "category_name", "view_count", "likes", "comment_count",
        "duration_seconds", "trending_count", "like_rate", "comment_rate"]
    assert result.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("partitions", [1, 7])
def test_result_does_not_depend_on_partitioning(spark, connection, partitions, monkeypatch):
    from sparkscope.plans import adapters, catalog

    def spread(session, sf_dir, name):
        return session.read.parquet(f"{sf_dir}/{name}.parquet").repartition(partitions)

    monkeypatch.setattr(adapters, "table", spread)
    monkeypatch.setattr(catalog, "table", spread)
    for name in ("prepare_trending", "dedup_keyed", "box_stats_by_group", "quantiles_by_group", "log_histogram",
                 "median_impute", "confusion_matrix", "min_class_filter", "hash_split"):
        assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connection, SQL[name]), name
