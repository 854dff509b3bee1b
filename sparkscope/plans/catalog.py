"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscope.functions.columns import (
    clean_names, coerce, duration_seconds, log10_positive, percent, ratio, recode, round_columns,
    string_key,
)
from sparkscope.operators import clean, distributions, evaluate, models, quantiles, reshape, rollup, sketches, split, stats
from sparkscope.operators.sorted_quantiles import sorted_quantiles
from sparkscope.plans import classification, clustering
from sparkscope.plans.adapters import grouped_parts, part_peaks, raw_snapshots, separable_parts, table
from sparkscope.plans.prepare import AUDIT, EXTENDED_PREDICTORS, PREDICTORS, SNAPSHOT_KEY, prepare, snapshot_order, typed_snapshots
from sparkscope.runtime import materialize, new_path
from sparkscope.sources import results, tables
from sparkscope.sources.split_csv import read_csv_splits

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL where there is one."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function
    return register


# --- SQL fragments ---------------------------------------------------------------

SNAPSHOTS_SQL = """snapshots AS (
  SELECT CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE 'v' || l_partkey END AS video_id,
         l_orderkey, l_partkey, l_suppkey,
         CAST(l_shipdate AS DATE) AS published_at,
         CAST([10, 23, 34, 24, 1, 2, NULL, 99, 20, 25, 26, 17][l_partkey % 12 + 1] AS DOUBLE) AS category_id,
         CASE WHEN l_orderkey % 223 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS trending_date,
         CASE WHEN l_orderkey % 227 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 0::DOUBLE
              ELSE l_extendedprice END AS view_count,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity END AS likes,
         l_discount AS dislikes,
         NULLIF(l_tax, 0) AS comment_count,
         CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN 'P1DT2H'
              WHEN l_orderkey % 37 = 0 THEN ''
              ELSE 'PT' || (l_linenumber % 3) || 'H' || (l_orderkey % 60) || 'M' || (l_partkey % 60) || 'S'
         END AS duration
  FROM lineitem)"""

SECONDS_SQL = """coalesce(TRY_CAST(regexp_extract(coalesce(duration, 'PT0S'), '([0-9]+)H', 1) AS INTEGER), 0) * 3600
    + coalesce(TRY_CAST(regexp_extract(coalesce(duration, 'PT0S'), '([0-9]+)M', 1) AS INTEGER), 0) * 60
    + coalesce(TRY_CAST(regexp_extract(coalesce(duration, 'PT0S'), '([0-9]+)S', 1) AS INTEGER), 0)"""

CATEGORIES_SQL = "categories(category_id, category_name) AS (VALUES " + ", ".join(
    "({}, '{}')".format(key, name) for key, name in tables.CATEGORY_NAMES.items()) + ")"

PREPARED_SQL = f"""{SNAPSHOTS_SQL}, {CATEGORIES_SQL},
deduped AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY video_id, trending_date
      ORDER BY view_count DESC NULLS LAST, likes DESC NULLS LAST, comment_count DESC NULLS LAST,
               duration ASC NULLS LAST, category_id ASC NULLS LAST, published_at ASC NULLS LAST) AS rn
    FROM snapshots) WHERE rn = 1),
required AS (
  SELECT * FROM deduped
  WHERE video_id IS NOT NULL AND trending_date IS NOT NULL AND view_count IS NOT NULL),
medians AS (
  SELECT quantile_disc(view_count, 0.5) AS v, quantile_disc(likes, 0.5) AS l,
         quantile_disc(comment_count, 0.5) AS c FROM required),
filled AS (
  SELECT video_id, trending_date,
         CAST(coalesce(category_id, -1) AS INTEGER) AS category_id,
         CASE WHEN view_count = 0 THEN (SELECT v FROM medians) ELSE view_count END AS view_count,
         coalesce(likes, (SELECT l FROM medians)) AS likes,
         coalesce(comment_count, (SELECT c FROM medians)) AS comment_count,
         CAST({SECONDS_SQL} AS INTEGER) AS duration_seconds
  FROM required),
prepared AS (
  SELECT video_id, category_id, category_name, max(view_count) AS view_count, max(likes) AS likes,
         max(comment_count) AS comment_count, max(duration_seconds) AS duration_seconds,
         count(*) AS trending_count, max(likes) / max(view_count) AS like_rate,
         max(comment_count) / max(view_count) AS comment_rate
  FROM filled LEFT JOIN categories USING (category_id)
  GROUP BY video_id, category_id, category_name
  HAVING max(view_count) > 0 AND max(likes) IS NOT NULL AND max(comment_count) IS NOT NULL)"""

PEAKS_SQL = """peaks AS (
  SELECT video_id, p_type AS category_name, view_count, likes, comment_count, duration_seconds, trending_count,
         likes / view_count AS like_rate, comment_count / view_count AS comment_rate
  FROM (SELECT l_partkey AS video_id, max(l_extendedprice) AS view_count, max(l_quantity) AS likes,
               max(l_tax) AS comment_count,
               max(CAST(l_orderkey % 60 * 60 + l_linenumber AS INTEGER)) AS duration_seconds,
               count(*) AS trending_count
        FROM lineitem GROUP BY l_partkey)
  JOIN part ON video_id = p_partkey
  WHERE view_count > 0)"""


def unit_sql(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def union_sql(template: str, names) -> str:
    return " UNION ALL ".join(template.replace("{c}", name) for name in names)


# --- Preparation -----------------------------------------------------------------

@query(f"WITH {PREPARED_SQL} SELECT * FROM prepared")
def prepare_trending(spark, sf):
    return prepare(raw_snapshots(spark, sf), tables.category_dimension(spark), accuracy=None)


@query(f"WITH {PREPARED_SQL} SELECT * FROM prepared")
def prepare_from_csv(spark, sf):
    """The whole path of a raw file: written and scanned as CSV with the declared schema."""
    raw = raw_snapshots(spark, sf)
    path = new_path(spark, "raw-csv")
    raw.select(*[
        (F.col(field.name) if field.name in raw.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in tables.SNAPSHOT_SCHEMA
    ]).write.option("header", True).option("escape", '"').csv(path)
    return prepare(tables.read_csv(spark, path), tables.category_dimension(spark), accuracy=None)


LINEITEM_COLUMNS = ("l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,"
                    "l_returnflag,l_linestatus,l_shipdate")


@query(f"SELECT count(*) AS n_rows, 11 AS n_columns, '{LINEITEM_COLUMNS}' AS column_names FROM lineitem")
def table_profile(spark, sf):
    return tables.table_profile(table(spark, sf, "lineitem")).drop("n_partitions", "n_filled_partitions")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_extendedprice) AS max_price
FROM lineitem WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus""")
def named_view(spark, sf):
    tables.register(table(spark, sf, "lineitem"), "sparkscope_lines")
    return spark.sql("""SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_extendedprice) AS max_price
        FROM sparkscope_lines WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus""")


@query(f"""WITH {SNAPSHOTS_SQL}, {CATEGORIES_SQL}
SELECT s.category_id, category_name, count(*) AS n
FROM (SELECT CAST(coalesce(category_id, -1) AS INTEGER) AS category_id FROM snapshots) s
LEFT JOIN categories c ON s.category_id = c.category_id GROUP BY s.category_id, category_name""")
def inline_dimension(spark, sf):
    ids = typed_snapshots(raw_snapshots(spark, sf)).select(
        F.coalesce("category_id", F.lit(-1)).cast("int").alias("category_id"))
    counts = rollup.group_counts(ids, ["category_id"])
    return rollup.lookup(counts, tables.category_dimension(spark), "category_id")


@query("""SELECT n_nationkey AS nation_key, n_name AS nation_name, n_name AS nation_name_2,
n_regionkey AS x2nd_key, n_regionkey AS share_percent FROM nation""")
def snake_case_names(spark, sf):
    return clean_names(table(spark, sf, "nation").selectExpr(
        "n_nationkey as nationKey", "n_name as `Nation Name`", "n_name as nationName",
        "n_regionkey as `2ndKey`", "n_regionkey as `share %`"))


@query("""SELECT o_orderkey,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS measure,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS whole,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def safe_casts(spark, sf):
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderkey % 7 = 0, concat('bad', o_custkey), cast(o_custkey as string)) as measure",
        "if(o_orderkey % 11 = 0, '', cast(o_custkey as string)) as whole",
        "if(o_orderkey % 13 = 0, 'oops', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")) as day")
    return coerce(texts, {"measure": "double", "whole": "int", "day": "date"})


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS size,
coalesce(NULLIF(o_orderstatus, 'P'), 'F') AS status
FROM orders WHERE o_totalprice > 1000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate IS NOT NULL""")
def project_filter(spark, sf):
    orders = clean.require(table(spark, sf, "orders"), ["o_orderdate"])
    kept = orders.filter((F.col("o_totalprice") > 1000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return kept.withColumns({
        "size": F.when(F.col("o_totalprice") > 200000, "large").otherwise("small"),
        "status": F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("F")),
    }).select("o_orderkey", "size", "status")


@query("""SELECT CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status,
round(100.0::DOUBLE * count(*) FILTER (o_totalprice > 150000) / count(*), 4) AS large_percentage
FROM orders GROUP BY o_orderstatus""")
def percent_round_recode(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count_if(F.col("o_totalprice") > 150000).alias("large"), F.count(F.lit(1)).alias("n"))
    shares = counts.select(
        recode("o_orderstatus", {"F": "Finished", "O": "Open"}).alias("status"),
        percent("large", "n").alias("large_percentage"))
    return round_columns(shares, ["large_percentage"], 4)


@query("""SELECT o_orderstatus || '_k' || substr(o_orderpriority, 1, 1) AS key, count(*) AS n
FROM orders GROUP BY 1""")
def string_keys(spark, sf):
    key = string_key("o_orderstatus", F.lit("_k"), F.substring("o_orderpriority", 1, 1))
    return rollup.group_counts(table(spark, sf, "orders").select(key.alias("key")), ["key"])


@query("""SELECT l_orderkey, l_partkey, l_linenumber, round(log10(l_extendedprice), 6) AS log_price,
CASE WHEN l_discount > 0 THEN round(log10(l_discount), 6) END AS log_discount FROM lineitem""")
def log_transform(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.round(log10_positive("l_extendedprice"), 6).alias("log_price"),
        F.round(log10_positive("l_discount"), 6).alias("log_discount"))


# --- Audits, filters, dedup --------------------------------------------------------

def labelled_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED_SQL = "labelled AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic " \
               "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query(f"""WITH {SNAPSHOTS_SQL}
SELECT count(*) FILTER (video_id IS NULL) AS video_id_na,
 count(*) FILTER (category_id IS NULL) AS category_id_na,
 count(*) FILTER (view_count IS NULL OR view_count = 0) AS view_count_na,
 count(*) FILTER (likes IS NULL) AS likes_na,
 count(*) FILTER (dislikes IS NULL OR dislikes = 0) AS dislikes_na,
 count(*) FILTER (comment_count IS NULL) AS comment_count_na,
 count(*) FILTER (published_at IS NULL) AS published_at_na,
 count(*) FILTER (trending_date IS NULL) AS trending_date_na,
 count(*) FILTER (duration IS NULL) AS duration_na FROM snapshots""")
def missing_audit(spark, sf):
    return clean.missing_audit(typed_snapshots(raw_snapshots(spark, sf)), {
        "video_id": False, "category_id": False, "view_count": True, "likes": False, "dislikes": True,
        "comment_count": False, "published_at": False, "trending_date": False, "duration": False})


AUDIT_ORDER = ", ".join(f"{c} NULLS LAST" for c in (
    "view_count DESC", "likes DESC", "comment_count DESC", "duration", "category_id", "published_at"))


@query(f"""WITH {SNAPSHOTS_SQL},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, trending_date
  ORDER BY {AUDIT_ORDER}, l_orderkey, l_suppkey, dislikes) AS rn FROM snapshots) WHERE rn = 1)
SELECT count(*) FILTER (video_id IS NULL) AS video_id_na, count(*) FILTER (l_orderkey % 5 = 0) AS title_na,
 count(*) FILTER (l_orderkey % 7 = 0) AS channel_id_na, count(*) FILTER (l_orderkey % 9 = 0) AS channel_title_na,
 count(*) FILTER (category_id IS NULL) AS category_id_na,
 count(*) FILTER (view_count IS NULL OR view_count = 0) AS view_count_na, count(*) FILTER (likes IS NULL) AS likes_na,
 count(*) FILTER (dislikes IS NULL OR dislikes = 0) AS dislikes_na,
 count(*) FILTER (comment_count IS NULL) AS comment_count_na, count(*) FILTER (published_at IS NULL) AS published_at_na,
 count(*) FILTER (trending_date IS NULL) AS trending_date_na, count(*) FILTER (duration IS NULL) AS duration_na FROM firsts""")
def full_audit(spark, sf):
    """All twelve audited columns, after the duplicates are resolved."""
    rows = typed_snapshots(raw_snapshots(spark, sf, ["l_orderkey", "l_suppkey"]))
    unique = clean.dedup_keyed(rows, SNAPSHOT_KEY, [*snapshot_order(), "l_orderkey", "l_suppkey", "dislikes"])
    return clean.missing_audit(unique, AUDIT)


@query("""SELECT count(*) AS total, count(*) FILTER (l_discount <> 0) AS l_discount_present,
count(*) FILTER (l_discount IS NULL OR l_discount = 0) AS l_discount_missing,
round(100.0::DOUBLE * count(*) FILTER (l_discount IS NULL OR l_discount = 0) / count(*), 6) AS missing_percentage
FROM lineitem""")
def missing_ratio(spark, sf):
    audit = clean.missing_ratio(table(spark, sf, "lineitem"), "l_discount", zero_is_missing=True)
    return round_columns(audit, ["missing_percentage"], 6)


@query(f"""WITH {LABELLED_SQL} SELECT count(*) AS total, count(quality) AS quality_present,
count(*) - count(quality) AS quality_missing,
round(100.0::DOUBLE * (count(*) - count(quality)) / count(*), 6) AS missing_percentage FROM labelled""")
def missing_ratio_nulls(spark, sf):
    audit = clean.missing_ratio(labelled_documents(spark, sf), "quality")
    return round_columns(audit, ["missing_percentage"], 6)


@query("""SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn = 1""")
def dedup_keyed(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "event_type", "value")
    return clean.dedup_keyed(events, ["user_id", "day"], [F.desc("value"), F.asc("event_id")])


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_pairs(spark, sf):
    return table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("""SELECT l_returnflag, "column", n_distinct, true AS within FROM (
  SELECT l_returnflag, count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey
  FROM lineitem GROUP BY l_returnflag) UNPIVOT (n_distinct FOR "column" IN (l_orderkey, l_partkey, l_suppkey))""")
def distinct_sketch(spark, sf):
    """Distinct counts of flags from stored sketches of (flag, month), within three standard errors of the exact counts."""
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    parts = materialize(sketches.distinct_sketches(
        lines.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")), columns, ["l_returnflag", "month"]), "distinct")
    estimates = sketches.distinct_estimates(sketches.merge_distinct(parts, ["l_returnflag"]), ["l_returnflag"])
    exact = lines.groupBy("l_returnflag").agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot(
        ["l_returnflag"], columns, "column", "exact")
    off = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return exact.join(estimates, ["l_returnflag", "column"]).select(
        "l_returnflag", "column", F.col("exact").alias("n_distinct"), (off <= 3 * 1.04 / 2 ** (sketches.HLL_LOG2 / 2)).alias("within"))


@query("SELECT count(DISTINCT c_nationkey) AS n_nations, count(DISTINCT c_mktsegment) AS n_segments FROM customer")
def distinct_count(spark, sf):
    return table(spark, sf, "customer").agg(
        F.count_distinct("c_nationkey").alias("n_nations"), F.count_distinct("c_mktsegment").alias("n_segments"))


@query(f"WITH {LABELLED_SQL} SELECT * FROM labelled WHERE quality IS NOT NULL")
def required_filter(spark, sf):
    return clean.require(labelled_documents(spark, sf), ["quality"])


@query(f"""WITH {LABELLED_SQL} SELECT * FROM labelled
WHERE n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def complete_cases(spark, sf):
    return clean.complete_cases(labelled_documents(spark, sf), ["n_chars", "quality", "toxic"])


@query(f"""WITH {LABELLED_SQL} SELECT doc_id, source, coalesce(CAST(quality AS VARCHAR), '') AS quality,
coalesce(CAST(toxic AS VARCHAR), '') AS toxic FROM labelled""")
def text_fill(spark, sf):
    texts = labelled_documents(spark, sf).select(
        "doc_id", "source", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    return clean.fill_text(texts, ["quality", "toxic"])


@query("""WITH m AS (SELECT quantile_disc(l_tax, 0.5) AS t, quantile_disc(NULLIF(l_discount, 0), 0.5) AS d FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber,
 CASE WHEN l_tax = 0 THEN (SELECT t FROM m) ELSE l_tax END AS l_tax,
 coalesce(NULLIF(l_discount, 0), (SELECT d FROM m)) AS l_discount FROM lineitem""")
def median_impute(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_tax", F.nullif("l_discount", F.lit(0)).alias("l_discount"))
    return quantiles.impute_median(lines, {"l_tax": True, "l_discount": False}, accuracy=None)


QUANTILE_COLUMNS = ["l_extendedprice", "l_quantity"]


@query(union_sql("""SELECT l_returnflag, '{c}' AS "column", p, value FROM (
  SELECT l_returnflag, unnest([0.1, 0.25, 0.5, 0.9]::DOUBLE[]) AS p,
         unnest(quantile_disc({c}, [0.1, 0.25, 0.5, 0.9])) AS value FROM lineitem GROUP BY l_returnflag)""",
                 QUANTILE_COLUMNS))
def quantiles_by_group(spark, sf):
    return quantiles.exact_quantiles(
        table(spark, sf, "lineitem"), QUANTILE_COLUMNS, [0.1, 0.25, 0.5, 0.9], ["l_returnflag"])


@query(union_sql("""SELECT '{c}' AS "column", p, round(value, 6) AS value FROM (
  SELECT unnest([0.05, 0.5, 0.95]::DOUBLE[]) AS p,
         unnest(quantile_cont({c}, [0.05, 0.5, 0.95])) AS value FROM lineitem)""", QUANTILE_COLUMNS))
def quantiles_interpolated(spark, sf):
    found = quantiles.exact_quantiles(
        table(spark, sf, "lineitem"), QUANTILE_COLUMNS, [0.05, 0.5, 0.95], interpolate=True)
    return round_columns(found, ["value"], 6)


def within_sql(probs, table_sql: str = "lineitem", by: str = "") -> str:
    """Every quantile within its rank error; the numbers of values are counted."""
    key = f"{by}, " if by else ""
    return union_sql(f"""SELECT {key}'{{c}}' AS "column", p, count({{c}}) AS n, true AS within
      FROM {table_sql}, (SELECT unnest({list(probs)}::DOUBLE[]) AS p) GROUP BY {key}p""", QUANTILE_COLUMNS)


def within(checked: DataFrame, allowed: float | Column) -> DataFrame:
    return checked.withColumn("within", F.col("rank_error") <= allowed).drop("value", "rank_error")


@query(union_sql("""SELECT '{c}' AS "column", p, value, n, true AS within FROM (
  SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS p, unnest(quantile_disc({c}, [0.25, 0.5, 0.75])) AS value, count({c}) AS n
  FROM lineitem)""", QUANTILE_COLUMNS))
def quantiles_sketch(spark, sf):
    """Exact quantiles found from the sketch, and whether the sketch's own are within its error of rows / accuracy, rounded up."""
    lines, probs = table(spark, sf, "lineitem"), [0.25, 0.5, 0.75]
    found = quantiles.refined_quantiles(lines, QUANTILE_COLUMNS, probs)
    checked = quantiles.rank_errors(lines, quantiles.quantiles(lines, QUANTILE_COLUMNS, probs))
    return found.join(within(checked, F.ceil(F.col("n") / quantiles.SKETCH_ACCURACY) / F.col("n")), ["column", "p"])


def daily_summaries(spark, sf) -> DataFrame:
    """One stored summary row per column and day."""
    days = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return materialize(sketches.summaries(days, QUANTILE_COLUMNS, ["day"]), "daily")


MONTH_SQL = "(SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem)"


@query(union_sql(f"""SELECT month, '{{c}}' AS "column", count({{c}}) AS n, round(avg({{c}}), 6) AS mean,
  round(stddev_samp({{c}}), 6) AS sd, min({{c}}) AS min, max({{c}}) AS max FROM {MONTH_SQL} GROUP BY month""", QUANTILE_COLUMNS))
def monthly_summaries(spark, sf):
    """Months described from the summaries of their days."""
    days = daily_summaries(spark, sf).withColumn("month", F.date_format("day", "yyyy-MM"))
    described = sketches.describe_summaries(sketches.merge_summaries(days, ["month"]), ["month"])
    return round_columns(described, ["mean", "sd"], 6).drop("median", "q1", "q3")


@query(within_sql([0.1, 0.5, 0.9], MONTH_SQL, "month"))
def monthly_sketch_quantiles(spark, sf):
    """Quantiles of months from the merged sketches of their days, checked in the data."""
    days = daily_summaries(spark, sf).withColumn("month", F.date_format("day", "yyyy-MM"))
    found = sketches.summary_quantiles(sketches.merge_summaries(days, ["month"]), [0.1, 0.5, 0.9], ["month"])
    lines = table(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return within(quantiles.rank_errors(lines, found, ["month"]), 2 * sketches.kll_rank_error())


@query(union_sql("""SELECT l_partkey, '{c}' AS "column", p, value FROM (
  SELECT l_partkey, unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS p,
         unnest(quantile_disc({c}, [0.1, 0.5, 0.9])) AS value FROM lineitem GROUP BY l_partkey)""", QUANTILE_COLUMNS))
def quantiles_of_many_groups(spark, sf):
    """As many groups as items, by one range-partitioned sort."""
    return sorted_quantiles(table(spark, sf, "lineitem"), QUANTILE_COLUMNS, [0.1, 0.5, 0.9], ["l_partkey"])


@query(f"""WITH {SNAPSHOTS_SQL} SELECT duration, CAST({SECONDS_SQL} AS INTEGER) AS seconds,
CAST(CASE WHEN duration = 'P1DT2H' THEN 93600 ELSE {SECONDS_SQL} END AS INTEGER) AS seconds_with_days,
count(*) AS n FROM snapshots GROUP BY ALL""")
def iso_duration(spark, sf):
    rows = typed_snapshots(raw_snapshots(spark, sf)).select(
        "duration", duration_seconds("duration").alias("seconds"),
        duration_seconds("duration", include_days=True).alias("seconds_with_days"))
    return rollup.group_counts(rows, ["duration", "seconds", "seconds_with_days"])


# --- Lookup, rollup, groups ----------------------------------------------------------

@query("""SELECT s_nationkey + 10 AS n_nationkey, s_suppkey, s_acctbal, n_name
FROM supplier LEFT JOIN nation ON s_nationkey + 10 = n_nationkey""")
def dim_lookup(spark, sf):
    """Keys above 24 are in no row of the dimension."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf, "supplier").select(
        (F.col("s_nationkey") + 10).alias("n_nationkey"), "s_suppkey", "s_acctbal")
    return rollup.lookup(suppliers, nations, "n_nationkey")


@query("""SELECT vec_id, label FROM embeddings
WHERE label IN (SELECT label FROM embeddings GROUP BY label HAVING count(*) >= 50)""")
def min_class_filter(spark, sf):
    return clean.frequent_classes(table(spark, sf, "embeddings").select("vec_id", "label"), "label", 50)


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= 35)""")
def frequent_among_many(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return clean.frequent_among_many(lines, "l_partkey", 35)


@query("""SELECT l_partkey, max(l_extendedprice) AS l_extendedprice, max(l_quantity) AS l_quantity,
max(l_tax) AS l_tax, count(*) AS trending_count FROM lineitem GROUP BY l_partkey""")
def peak_rollup(spark, sf):
    return rollup.peak_rollup(
        table(spark, sf, "lineitem"), ["l_partkey"], ["l_extendedprice", "l_quantity", "l_tax"])


@query(f"""WITH {PEAKS_SQL} SELECT video_id, like_rate, comment_rate,
(likes + comment_count) / view_count AS engagement_rate FROM peaks""")
def engagement_ratios(spark, sf):
    return part_peaks(spark, sf).select(
        "video_id", "like_rate", "comment_rate",
        ratio(F.col("likes") + F.col("comment_count"), "view_count").alias("engagement_rate"))


@query("""SELECT p_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM part), 6) AS share
FROM part GROUP BY p_type""")
def class_balance(spark, sf):
    return round_columns(rollup.class_balance(table(spark, sf, "part"), "p_type"), ["share"], 6)


@query("SELECT l_returnflag, l_shipdate::DATE AS day, count(*) AS n FROM lineitem GROUP BY ALL")
def group_counts(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("day"))
    return rollup.group_counts(lines, ["l_returnflag", "day"])


@query("""SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 6) AS l_extendedprice,
round(avg(l_discount), 6) AS l_discount FROM lineitem GROUP BY l_returnflag""")
def group_means(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    return round_columns(rollup.group_means(table(spark, sf, "lineitem"), ["l_returnflag"], names), names, 6)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sorted_top_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return reshape.top_n(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


# --- Statistics and distributions ------------------------------------------------------

MEASURES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
DESCRIBE_SQL = """SELECT '{c}' AS "column", round(avg({c}), 8) AS mean, round(stddev_samp({c}), 6) AS sd,
 min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, quantile_disc({c}, 0.25)::DOUBLE AS q1,
 quantile_disc({c}, 0.5)::DOUBLE AS median, quantile_disc({c}, 0.75)::DOUBLE AS q3 FROM """


def rounded_description(description: DataFrame) -> DataFrame:
    # Means of two-digit values over round row counts end in a 5 at seven digits.
    return round_columns(round_columns(description, ["mean"], 8), ["sd"], 6)


@query(union_sql(DESCRIBE_SQL + "lineitem", MEASURES))
def describe_numeric(spark, sf):
    return rounded_description(stats.describe_numeric(table(spark, sf, "lineitem"), MEASURES, accuracy=None))


@query(f"WITH {PREPARED_SQL} " + union_sql(DESCRIBE_SQL + "prepared", PREDICTORS))
def describe_prepared(spark, sf):
    return rounded_description(stats.describe_numeric(materialize(prepare_trending(spark, sf)), PREDICTORS, accuracy=None))


HISTOGRAM_SQL = """SELECT '{c}' AS "column", CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS log_lo,
 round(lo + (b + 1) * w, 6) AS log_hi, coalesce(n, 0) AS n, n_dropped
FROM (SELECT min(log10({c})) FILTER ({c} > 0) AS lo,
             (max(log10({c})) FILTER ({c} > 0) - min(log10({c})) FILTER ({c} > 0)) / 50 AS w,
             count(*) FILTER ({c} IS NULL OR {c} <= 0) AS n_dropped
      FROM (SELECT CASE WHEN {c} > 0 THEN {c} END AS {c} FROM lineitem)) r
CROSS JOIN generate_series(0, 49) g(b)
LEFT JOIN (SELECT least(floor((log10({c}) - s.lo) / s.w), 49) AS bin, count(*) AS n
           FROM lineitem, (SELECT min(log10({c})) AS lo, (max(log10({c})) - min(log10({c}))) / 50 AS w
                           FROM lineitem WHERE {c} > 0) s
           WHERE {c} > 0 GROUP BY 1) c ON c.bin = b"""


@query(union_sql(HISTOGRAM_SQL, MEASURES))
def log_histogram(spark, sf):
    return round_columns(
        distributions.log_histogram(table(spark, sf, "lineitem"), MEASURES), ["log_lo", "log_hi"], 6)


# Columns without any positive value, and a group without one.
SIGNED_SQL = ("(SELECT l_returnflag, -l_quantity AS negative, "
              "CASE WHEN l_returnflag = 'R' THEN -l_tax ELSE l_extendedprice END AS mixed FROM lineitem)")
SIGNED = ["mixed", "negative"]


def signed_lines(spark, sf) -> DataFrame:
    """``lineitem`` with a NaN in place of a third of the values without a logarithm."""
    def odd(value):
        return F.when((value <= 0) & (F.col("l_orderkey") % 3 == 0), F.lit(float("nan"))).otherwise(value)
    mixed = F.when(F.col("l_returnflag") == "R", -F.col("l_tax")).otherwise(F.col("l_extendedprice"))
    return table(spark, sf, "lineitem").select("l_returnflag", odd(-F.col("l_quantity")).alias("negative"), odd(mixed).alias("mixed"))


@query(union_sql(HISTOGRAM_SQL.replace("FROM lineitem", f"FROM {SIGNED_SQL}"), SIGNED))
def log_histogram_signed(spark, sf):
    return round_columns(distributions.log_histogram(signed_lines(spark, sf), SIGNED), ["log_lo", "log_hi"], 6)


BOX_COLUMNS = ["l_extendedprice", "l_quantity", "l_discount"]
BOX_ROUNDED = ["q1", "median", "q3", "whisker_lo", "whisker_hi"]


def box_sql(by: str = "", source: str = "lineitem", columns=tuple(BOX_COLUMNS), ranked: bool = True) -> str:
    key, group, rank = "", "", ""
    join = "CROSS JOIN q"
    if by:
        key, group, join = f"{by}, ", f"GROUP BY {by}", f"JOIN q USING ({by})"
    if by and ranked:
        rank = f", CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY median, {by}) AS INTEGER) AS rank"
    return f"""SELECT *{rank} FROM (SELECT * FROM ({union_sql(f'''SELECT * FROM (
  WITH x AS (SELECT {key}CASE WHEN {{c}} > 0 THEN log10({{c}}) END AS x
             FROM (SELECT {key}CASE WHEN {{c}} > 0 THEN {{c}} END AS {{c}} FROM {source})),
  q AS (SELECT {key}quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.5) AS m, quantile_cont(x, 0.75) AS b
        FROM x {group})
  SELECT {key}'{{c}}' AS "column", round(a, 6) AS q1, round(m, 6) AS median, round(b, 6) AS q3, count(x) AS n,
    round(min(x) FILTER (x BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)), 6) AS whisker_lo,
    round(max(x) FILTER (x BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)), 6) AS whisker_hi,
    count(*) FILTER (x NOT BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS n_outliers,
    count(*) FILTER (x IS NULL) AS n_dropped
  FROM x {join} GROUP BY {key}a, m, b)''', columns)}))"""


@query(box_sql())
def box_stats(spark, sf):
    return round_columns(distributions.box_stats(table(spark, sf, "lineitem"), BOX_COLUMNS), BOX_ROUNDED, 6)


@query(box_sql("l_returnflag"))
def box_stats_by_group(spark, sf):
    return round_columns(
        distributions.box_stats(table(spark, sf, "lineitem"), BOX_COLUMNS, ["l_returnflag"]), BOX_ROUNDED, 6)


@query(box_sql("l_partkey", ranked=False))
def box_stats_of_many_groups(spark, sf):
    found = distributions.box_stats(table(spark, sf, "lineitem"), BOX_COLUMNS, ["l_partkey"], ranked=False, quantiles=sorted_quantiles)
    return round_columns(found, BOX_ROUNDED, 6)


@query(box_sql("l_returnflag", SIGNED_SQL, SIGNED))
def box_stats_signed(spark, sf):
    """A column and a group without positive values keep their rows."""
    return round_columns(distributions.box_stats(signed_lines(spark, sf), SIGNED, ["l_returnflag"]), BOX_ROUNDED, 6)


DENSITY_PAIRS = [("l_extendedprice", "l_quantity"), ("l_extendedprice", "l_tax"), ("l_quantity", "l_tax")]


@query(" UNION ALL ".join(f"""SELECT '{x}' AS x, '{y}' AS y, CAST(floor(log10({x}) / 0.1::DOUBLE) AS INTEGER) AS x_cell,
 CAST(floor(log10({y}) / 0.1::DOUBLE) AS INTEGER) AS y_cell, count(*) AS n
 FROM (SELECT * FROM lineitem WHERE {x} > 0 AND {y} > 0) GROUP BY ALL""" for x, y in DENSITY_PAIRS))
def pair_density(spark, sf):
    return distributions.pair_density(table(spark, sf, "lineitem"), DENSITY_PAIRS, 0.1)


@query(f"WITH {PEAKS_SQL} " + " UNION ALL ".join(
    f"SELECT '{x}' AS var1, '{y}' AS var2, round(corr({x}, {y}), 6) AS value FROM peaks"
    for x in PREDICTORS for y in PREDICTORS))
def corr_long(spark, sf):
    return round_columns(stats.correlation_long(part_peaks(spark, sf), PREDICTORS), ["value"], 6)


@query("""WITH pairs AS (SELECT unnest(range(1, 65)) AS i), grid AS (SELECT a.i, b.i AS j FROM pairs a, pairs b)
SELECT 'e' || i AS var1, 'e' || j AS var2, round(corr(embedding[i]::DOUBLE, embedding[j]::DOUBLE), 6) AS value
FROM embeddings, grid GROUP BY i, j""")
def corr_wide(spark, sf):
    """All pairs of 64 columns in one aggregate."""
    names = [f"e{i}" for i in range(1, 65)]
    wide = table(spark, sf, "embeddings").select(*[F.col("embedding")[i].alias(name) for i, name in enumerate(names)])
    return round_columns(stats.correlation_wide(wide, names), ["value"], 6)


@query(f"WITH {PEAKS_SQL} " + " UNION ALL ".join(
    f"""SELECT 'engagement_rate' AS candidate, '{y}' AS kept,
    round(corr((likes + comment_count) / view_count, {y}), 6) AS value,
    abs(corr((likes + comment_count) / view_count, {y})) >= 0.95 AS redundant FROM peaks""" for y in PREDICTORS))
def redundant_features(spark, sf):
    peaks = part_peaks(spark, sf).withColumn(
        "engagement_rate", ratio(F.col("likes") + F.col("comment_count"), "view_count"))
    return round_columns(stats.redundant_features(peaks, ["engagement_rate"], PREDICTORS), ["value"], 6)


# --- Splits --------------------------------------------------------------------------------

@query(f"""SELECT o_orderkey, CASE WHEN {unit_sql('o_orderkey', '42:split')} < 0.8 THEN 'training' ELSE 'test' END AS part
FROM orders""")
def hash_split(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", split.hash_split("o_orderkey", classification.SPLIT).alias("part"))


@query(f"SELECT o_orderkey, CAST(floor({unit_sql('o_orderkey', '42:fold')} * 3) AS INTEGER) AS fold FROM orders")
def kfold_assign(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", split.fold_number("o_orderkey", 3).alias("fold"))


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {unit_sql('o_orderkey', '42:sample')} < 0.05")
def hash_sample(spark, sf):
    return split.hash_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.05)


@query()
def bernoulli_sample(spark, sf):
    return split.bernoulli_sample(table(spark, sf, "orders"), 0.05)


@query()
def random_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    training, test = split.random_split(orders, "o_orderkey", [0.8, 0.2], partitions=8)
    return reshape.stack_tagged({"training": training, "test": test}, "part")


# --- Features --------------------------------------------------------------------------------

@query("""SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS label,
count(*) AS n FROM part GROUP BY p_type""")
def label_index(spark, sf):
    parts = table(spark, sf, "part").select("p_type")
    return rollup.group_counts(models.fit_label_index(parts, "p_type").transform(parts), ["p_type", "label"])


@query(f"WITH {PEAKS_SQL} " + " UNION ALL ".join(
    f"SELECT video_id, {i} AS position, {c}::DOUBLE AS value FROM peaks" for i, c in enumerate(PREDICTORS)))
def vector_assemble(spark, sf):
    assembled = models.assembler(PREDICTORS).transform(part_peaks(spark, sf))
    return assembled.select("video_id", F.posexplode(vector_to_array("features_raw")).alias("position", "value"))


def unpacked(scaled: DataFrame, names) -> DataFrame:
    values = vector_to_array("features")
    return scaled.select("video_id", *[F.round(values[i], 6).alias(name) for i, name in enumerate(names)])


@query(f"WITH {PEAKS_SQL} SELECT video_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in PREDICTORS) + " FROM peaks")
def standard_scale(spark, sf):
    return unpacked(clustering.scaled_features(materialize(part_peaks(spark, sf)), PREDICTORS, ["video_id"]), PREDICTORS)


@query(f"WITH {PEAKS_SQL} SELECT video_id, " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in PREDICTORS)
    + " FROM peaks")
def minmax_scale(spark, sf):
    return unpacked(
        clustering.scaled_features(materialize(part_peaks(spark, sf)), PREDICTORS, ["video_id"], minmax=True), PREDICTORS)


# --- Evaluation, on rule-based predictors over whole tables -----------------------------------

RULES = {
    "price rule": "case when o_totalprice < 100000 then '1-URGENT' when o_totalprice < 200000 then '2-HIGH' "
                  "when o_totalprice < 300000 then '3-MEDIUM' else '5-LOW' end",
    "customer rule": "case o_custkey % 4 when 0 then '1-URGENT' when 1 then '3-MEDIUM' when 2 then '4-NOT SPECIFIED' "
                     "else '5-LOW' end",
    "status rule": "case o_orderstatus when 'F' then '2-HIGH' when 'O' then '5-LOW' else 'OTHER' end",
}
BY = ["scenario"]


def rule_predictions(spark, sf) -> DataFrame:
    """One row per order and rule: what the rule says about the order's priority."""
    rules = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("scenario"), F.expr(rule).alias("predicted"))
        for i, (name, rule) in enumerate(RULES.items(), 1)])
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("actual"), split.fold_number("o_orderkey", 3).alias("fold"), F.inline(rules))


RULES_SQL = "predictions AS (" + " UNION ALL ".join(
    f"""SELECT {i} AS ordinal, '{name}' AS scenario, o_orderpriority AS actual, {rule} AS predicted,
    CAST(floor({unit_sql('o_orderkey', '42:fold')} * 3) AS INTEGER) AS fold FROM orders"""
    for i, (name, rule) in enumerate(RULES.items(), 1)) + ")"

CLASSES_SQL = f"""{RULES_SQL},
classes AS (
  SELECT scenario, actual AS class, count(*) AS actual_n, count(*) FILTER (actual = predicted) AS tp
  FROM predictions GROUP BY 1, 2),
guesses AS (SELECT scenario, predicted AS class, count(*) AS predicted_n FROM predictions GROUP BY 1, 2),
scored AS (
  SELECT c.scenario, c.class, coalesce(tp::DOUBLE / nullif(predicted_n, 0), 0::DOUBLE) AS precision,
         tp::DOUBLE / actual_n AS recall, tp, actual_n, coalesce(predicted_n, 0) AS predicted_n
  FROM classes c LEFT JOIN guesses g ON c.scenario = g.scenario AND c.class = g.class),
metrics AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0::DOUBLE
                 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM scored)"""

COMPARISON_SQL = f"""{CLASSES_SQL},
macro AS (
  SELECT scenario, CAST(sum(tp) AS DOUBLE) / CAST(sum(actual_n) AS DOUBLE) AS accuracy, avg(f1) AS macro_f1,
         avg(precision) AS macro_precision, avg(recall) AS macro_recall FROM metrics GROUP BY scenario),
folds AS (
  SELECT scenario, fold, avg(CASE WHEN actual = predicted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
  FROM predictions GROUP BY scenario, fold),
comparison AS (
  SELECT ordinal, m.scenario, round(accuracy, 4) AS accuracy, round(macro_f1, 4) AS macro_f1,
         round(macro_precision, 4) AS macro_precision, round(macro_recall, 4) AS macro_recall,
         round(cv_accuracy, 4) AS cv_accuracy
  FROM macro m
  JOIN (SELECT scenario, avg(accuracy) AS cv_accuracy FROM folds GROUP BY scenario) f ON m.scenario = f.scenario
  JOIN (SELECT DISTINCT ordinal, scenario FROM predictions) o ON m.scenario = o.scenario)"""


@query(f"""WITH {RULES_SQL}, rows AS (SELECT DISTINCT scenario, predicted FROM predictions),
cols AS (SELECT DISTINCT scenario, actual FROM predictions)
SELECT r.scenario, r.predicted, c.actual, (SELECT count(*) FROM predictions p WHERE p.scenario = r.scenario
  AND p.predicted = r.predicted AND p.actual = c.actual) AS n
FROM rows r JOIN cols c ON r.scenario = c.scenario""")
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(rule_predictions(spark, sf), "actual", "predicted", BY)


def rule_classes(spark, sf) -> DataFrame:
    counts = evaluate.confusion_counts(rule_predictions(spark, sf), "actual", "predicted", BY)
    return evaluate.class_metrics(counts, BY)


def rule_folds(spark, sf) -> DataFrame:
    return evaluate.fold_accuracy(rule_predictions(spark, sf), "actual", "predicted", ["scenario", "fold"])


def rule_comparison(spark, sf) -> DataFrame:
    ordinals = tables.inline_dimension(spark, enumerate(RULES, 1), "ordinal int, scenario string")
    return classification.scenario_comparison(rule_classes(spark, sf), rule_folds(spark, sf), ordinals)


@query(f"""WITH {CLASSES_SQL} SELECT scenario, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
round(f1, 6) AS f1, tp, actual_n, predicted_n FROM metrics""")
def class_metrics(spark, sf):
    return round_columns(rule_classes(spark, sf), ["precision", "recall", "f1"], 6)


@query(f"""WITH {COMPARISON_SQL} SELECT scenario, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
round(macro_precision, 6) AS macro_precision, round(macro_recall, 6) AS macro_recall FROM macro""")
def macro_metrics(spark, sf):
    return round_columns(evaluate.macro_metrics(rule_classes(spark, sf), BY), classification.METRICS, 6)


@query(f"WITH {COMPARISON_SQL} SELECT scenario, fold, round(accuracy, 6) AS accuracy FROM folds")
def fold_accuracy(spark, sf):
    return round_columns(rule_folds(spark, sf), ["accuracy"], 6)


@query(f"WITH {COMPARISON_SQL} SELECT * FROM comparison")
def scenario_comparison(spark, sf):
    return rule_comparison(spark, sf)


@query(f"WITH {COMPARISON_SQL} SELECT * FROM comparison ORDER BY macro_f1 DESC, ordinal LIMIT 1")
def best_scenario(spark, sf):
    return reshape.best_row(rule_comparison(spark, sf), "macro_f1", "ordinal")


@query(f"WITH {COMPARISON_SQL} " + union_sql(
    "SELECT scenario, '{c}' AS metric, {c} AS value FROM comparison", [*classification.METRICS, "cv_accuracy"]))
def unpivot_metrics(spark, sf):
    return reshape.melt(
        rule_comparison(spark, sf), ["scenario"], [*classification.METRICS, "cv_accuracy"], "metric", "value")


@query(f"""WITH {COMPARISON_SQL} SELECT scenario, NULL::INTEGER AS fold, accuracy, macro_f1 FROM comparison
UNION ALL SELECT scenario, fold, round(accuracy, 4), NULL FROM folds""")
def stack_results(spark, sf):
    return reshape.stack([
        rule_comparison(spark, sf).select("scenario", "accuracy", "macro_f1"),
        round_columns(rule_folds(spark, sf), ["accuracy"], 4),
    ])


def saved_results(spark, sf) -> dict[str, DataFrame]:
    """Scenario comparison and class metrics, saved and loaded again."""
    folder = new_path(spark, "results")
    results.save_results(
        {"comparison": rule_comparison(spark, sf), "per_class": rule_classes(spark, sf)}, folder)
    return results.load_results(spark, folder, ["comparison", "per_class"])


def rule_algorithms(spark, sf) -> DataFrame:
    comparison = saved_results(spark, sf)["comparison"]
    return classification.compare_algorithms(
        {name: comparison.filter(F.col("scenario") == name) for name in RULES})


@query(f"""WITH {COMPARISON_SQL} SELECT scenario AS algorithm, scenario, accuracy, macro_f1, macro_precision,
macro_recall, cv_accuracy, round(cv_accuracy - accuracy, 4) AS generalization FROM comparison""")
def algorithm_comparison(spark, sf):
    return rule_algorithms(spark, sf)


@query(f"""WITH {COMPARISON_SQL} SELECT scenario AS algorithm, scenario, accuracy, macro_f1, macro_precision,
macro_recall, cv_accuracy, round(cv_accuracy - accuracy, 4) AS generalization FROM comparison
ORDER BY macro_f1 DESC, ordinal LIMIT 1""")
def overall_best(spark, sf):
    comparison = saved_results(spark, sf)["comparison"]
    return classification.overall_best({name: comparison.filter(F.col("scenario") == name) for name in RULES})


@query(f"""WITH {COMPARISON_SQL} SELECT scenario AS algorithm, 'CV Accuracy' AS type, cv_accuracy AS value,
 round(cv_accuracy - accuracy, 4) AS generalization FROM comparison
UNION ALL SELECT scenario, 'Test Accuracy', accuracy, round(cv_accuracy - accuracy, 4) FROM comparison""")
def generalization_gap(spark, sf):
    long = reshape.melt(rule_algorithms(spark, sf), ["algorithm", "generalization"], ["cv_accuracy", "accuracy"],
                        "type", "value")
    return long.withColumn("type", recode("type", {"cv_accuracy": "CV Accuracy", "accuracy": "Test Accuracy"}))


@query(f"""WITH {CLASSES_SQL} SELECT scenario AS algorithm, class, round(f1, 6) AS f1 FROM metrics""")
def class_f1_by_algorithm(spark, sf):
    per_class = saved_results(spark, sf)["per_class"]
    frames = {name: per_class.filter(F.col("scenario") == name).select("class", F.round("f1", 6).alias("f1"))
              for name in RULES}
    return reshape.stack_tagged(frames, "algorithm")


@query(f"""WITH {CLASSES_SQL} SELECT scenario, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
round(f1, 6) AS f1, tp, actual_n, predicted_n FROM metrics""")
def results_roundtrip(spark, sf):
    return round_columns(saved_results(spark, sf)["per_class"], ["precision", "recall", "f1"], 6)


@query("SELECT * FROM customer")
def csv_roundtrip(spark, sf):
    customers = table(spark, sf, "customer")
    path = new_path(spark, "csv")
    customers.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_csv(spark, path, customers.schema)


@query("SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_documents(spark, sf):
    """Whole documents, with line breaks and quotes in their texts, to CSV and back in splits; CSV has no empty text."""
    documents = table(spark, sf, "documents")
    path = new_path(spark, "csv")
    writer = documents.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv_splits(spark, path, documents.schema)


@query("SELECT count(*) AS n_rows, 4 AS n_columns, 's_suppkey,s_name,s_nationkey,s_acctbal' AS column_names, "
       "4 AS n_partitions, 4 AS n_filled_partitions FROM supplier")
def partition_profile(spark, sf):
    return tables.table_profile(table(spark, sf, "supplier").repartition(4))


# --- Classification studies --------------------------------------------------------------------

ALGORITHMS = {"Logistic Regression": models.LOGISTIC_SCENARIOS, "SVM": models.SVM_SCENARIOS,
              "Random Forest": models.FOREST_SCENARIOS}
# Classes with fewer samples are left out of the studies.
MIN_SAMPLES = 50


def study_table(spark, sf) -> DataFrame:
    return classification.modelling_table(part_peaks(spark, sf), "video_id", "category_name", min_samples=MIN_SAMPLES)


def study(spark, sf, scenarios) -> classification.ClassificationStudy:
    return classification.run_study(study_table(spark, sf), "category_name", scenarios)


@query()
def lr_study(spark, sf):
    return study(spark, sf, models.LOGISTIC_SCENARIOS).comparison


@query()
def svc_study(spark, sf):
    return study(spark, sf, models.SVM_SCENARIOS).comparison


@query()
def rf_study(spark, sf):
    return study(spark, sf, models.FOREST_SCENARIOS).comparison


def saved_studies(spark, sf) -> dict[str, str]:
    """All scenarios of all three algorithms on separable classes, fitted and saved."""
    data = classification.modelling_table(separable_parts(spark, sf), "video_id", "category_name", min_samples=MIN_SAMPLES)
    folders = {name: new_path(spark, "study") for name in ALGORITHMS}
    for name, scenarios in ALGORITHMS.items():
        classification.save_study(classification.run_study(data, "category_name", scenarios), folders[name])
    return folders


# Every part's class is certain, so all metrics are 1 wherever there are parts to test and to validate.
PERFECT_SQL = """SELECT '{name}' AS algorithm, '{first}' AS scenario, count(*) / count(*)::DOUBLE AS accuracy,
 count(*) / count(*)::DOUBLE AS macro_f1, count(*) / count(*)::DOUBLE AS macro_precision,
 count(*) / count(*)::DOUBLE AS macro_recall, count(*) / count(*)::DOUBLE AS cv_accuracy, 0.0::DOUBLE AS generalization
FROM part"""


@query(" UNION ALL ".join(PERFECT_SQL.format(name=name, first=s[0].name) for name, s in ALGORITHMS.items()))
def saved_study_comparison(spark, sf):
    """Three fitted, saved and reloaded studies, compared."""
    return classification.compare_saved(spark, saved_studies(spark, sf))[0]


def separable_study(spark, sf, scenarios) -> DataFrame:
    """Confusion counts on the test part and on each fold left out, of every scenario."""
    data = classification.modelling_table(separable_parts(spark, sf), "video_id", "category_name", min_samples=MIN_SAMPLES)
    fitted = classification.run_study(data, "category_name", scenarios)
    tested = fitted.predictions.withColumn("fold", F.lit(-1))
    both = tested.unionByName(fitted.validated)
    return evaluate.confusion_counts(both, "category_name", "predicted_label", ["scenario", "fold"])


def separable_sql(scenarios) -> str:
    split_at, fold = unit_sql("p_partkey", "42:split"), unit_sql("p_partkey", "42:fold")
    return " UNION ALL ".join(f"""SELECT '{s.name}' AS scenario,
      CASE WHEN {split_at} < 0.8 THEN CAST(floor({fold} * 3) AS INTEGER) ELSE -1 END AS fold,
      'class ' || p_partkey % 3 AS actual, 'class ' || p_partkey % 3 AS predicted, count(*) AS n
    FROM part GROUP BY ALL""" for s in scenarios)


@query(separable_sql(models.LOGISTIC_SCENARIOS))
def lr_separable(spark, sf):
    return separable_study(spark, sf, models.LOGISTIC_SCENARIOS)


@query(separable_sql(models.SVM_SCENARIOS))
def svc_separable(spark, sf):
    return separable_study(spark, sf, models.SVM_SCENARIOS)


@query(separable_sql(models.FOREST_SCENARIOS))
def rf_separable(spark, sf):
    return separable_study(spark, sf, models.FOREST_SCENARIOS)


DEEP_FOREST = models.deep_forest("Deep: num_trees=100, max_depth=10", 100, 10)


@query(separable_sql([DEEP_FOREST]))
def rf_deep(spark, sf):
    """Deep trees with cached, checkpointed nodes and a memory budget."""
    return separable_study(spark, sf, [DEEP_FOREST])


@query()
def cv_accuracy(spark, sf):
    return reshape.stack_tagged(
        {name: study(spark, sf, scenarios).fold_accuracies for name, scenarios in ALGORITHMS.items()}, "algorithm")


def best_forest(spark, sf):
    fitted = study(spark, sf, models.FOREST_SCENARIOS)
    return fitted.models[fitted.best().first().scenario]


@query()
def rf_importance(spark, sf):
    return models.feature_importance(spark, best_forest(spark, sf), PREDICTORS)


@query(f"SELECT count(*) / count(*) * {len(PREDICTORS)} AS predictors, count(*) / count(*)::DOUBLE AS total FROM part")
def rf_importance_total(spark, sf):
    """Every predictor has an importance and they add up to one."""
    shares = rf_importance(spark, sf)
    return shares.agg(F.count("importance").cast("double").alias("predictors"), F.round(F.sum("importance"), 6).alias("total"))


@query("""SELECT feature, CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS importance FROM (
  SELECT count(DISTINCT p_partkey % 3) AS view_count, count(DISTINCT 0) AS likes, count(DISTINCT 1) AS comment_count FROM part)
UNPIVOT (n FOR feature IN (view_count, likes, comment_count))""")
def rf_importance_informative(spark, sf):
    """One column tells the classes apart and the others never vary: all importance is its own."""
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey as video_id", "concat('class ', p_partkey % 3) as category_name",
        "cast(p_partkey % 3 as double) as view_count", "0D as likes", "1D as comment_count")
    columns = ["view_count", "likes", "comment_count"]
    data = classification.modelling_table(parts, "video_id", "category_name", columns, min_samples=MIN_SAMPLES)
    index = models.fit_label_index(data, "category_name")
    model = models.classifier_pipeline(models.FOREST_SCENARIOS[0], columns, index).fit(data.filter("part = 'training'"))
    return round_columns(models.feature_importance(spark, model, columns), ["importance"], 6)


def fitted_forest(spark, sf):
    data = study_table(spark, sf)
    index = models.fit_label_index(data, "category_name")
    train = data.filter("part = 'training'")
    return models.classifier_pipeline(models.FOREST_SCENARIOS[0], PREDICTORS, index).fit(train), data


@query(f"""WITH {PEAKS_SQL}, labels AS (SELECT string_agg(category_name, ',' ORDER BY n DESC, category_name) AS labels FROM (
  SELECT category_name, count(*) AS n FROM peaks GROUP BY category_name HAVING count(*) >= {MIN_SAMPLES}))
SELECT 0 AS stage, 'StringIndexerModel' AS name, labels FROM labels
UNION ALL SELECT 1, 'VectorAssembler', NULL UNION ALL SELECT 2, 'RandomForestClassificationModel', NULL""")
def pipeline_stages(spark, sf):
    model = fitted_forest(spark, sf)[0]
    stages = [(i, name, ",".join(model.stages[0].labels) if i == 0 else None)
              for i, name in models.stage_summary(model)]
    return spark.createDataFrame(stages, "stage int, name string, labels string")


@query("SELECT p_type, p_type AS label_name, count(*) AS n FROM part GROUP BY p_type")
def label_names(spark, sf):
    """Classes to indexes and back."""
    parts = table(spark, sf, "part").select("p_type")
    index = models.fit_label_index(parts, "p_type")
    named = models.label_names(index.transform(parts), "label", "label_name", index.labels)
    return rollup.group_counts(named, ["p_type", "label_name"])


@query()
def model_roundtrip(spark, sf):
    model, data = fitted_forest(spark, sf)
    path = new_path(spark, "model")
    results.save_model(model, path)
    return models.predict(results.load_model(path), data.filter("part = 'test'"), "category_name", ["video_id"])


# --- Clustering ------------------------------------------------------------------------------------

def rule_clusters(spark, sf) -> DataFrame:
    """Peak rows with a rule-based cluster, so that SQL can follow."""
    return part_peaks(spark, sf).withColumn("prediction", (F.col("duration_seconds") % 4).cast("int"))


CLUSTERS_SQL = PEAKS_SQL + ", clusters AS (SELECT *, duration_seconds % 4 AS prediction FROM peaks)"
PROFILE_SQL = CLUSTERS_SQL + ", profile AS (SELECT prediction, " + ", ".join(
    f"avg({c}) AS {c}" for c in EXTENDED_PREDICTORS) + " FROM clusters GROUP BY prediction)"


@query(f"WITH {CLUSTERS_SQL} SELECT prediction, count(*) AS n FROM clusters GROUP BY prediction")
def cluster_sizes(spark, sf):
    return clustering.cluster_sizes(rule_clusters(spark, sf))


@query(f"WITH {PROFILE_SQL} SELECT prediction, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in EXTENDED_PREDICTORS) + " FROM profile")
def cluster_profile(spark, sf):
    profile = clustering.cluster_profile(rule_clusters(spark, sf), EXTENDED_PREDICTORS)
    return round_columns(profile, EXTENDED_PREDICTORS, 6)


def scaled_sql(c: str) -> str:
    return f"round(coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0), 6)"


@query(f"WITH {PROFILE_SQL} SELECT prediction, " + ", ".join(
    f"{scaled_sql(c)} AS {c}" for c in EXTENDED_PREDICTORS) + " FROM profile")
def cluster_profile_scaled(spark, sf):
    profile = clustering.cluster_profile(rule_clusters(spark, sf), EXTENDED_PREDICTORS)
    return round_columns(
        clustering.cluster_profile_scaled(profile, EXTENDED_PREDICTORS), EXTENDED_PREDICTORS, 6)


@query(f"WITH {PROFILE_SQL} " + " UNION ALL ".join(
    f"SELECT prediction, '{c}' AS feature, {scaled_sql(c)} AS value FROM profile" for c in EXTENDED_PREDICTORS))
def cluster_heatmap_long(spark, sf):
    profile = clustering.cluster_profile(rule_clusters(spark, sf), EXTENDED_PREDICTORS)
    return round_columns(clustering.cluster_heatmap(profile, EXTENDED_PREDICTORS), ["value"], 6)


@query(f"""WITH {CLUSTERS_SQL} SELECT video_id, view_count, like_rate, prediction FROM clusters
WHERE {unit_sql('video_id', '42:sample')} < 0.05""")
def cluster_sample_2d(spark, sf):
    return clustering.cluster_sample(rule_clusters(spark, sf), "video_id", "view_count", "like_rate")


@query(f"""WITH {CLUSTERS_SQL} SELECT prediction, 'view_count' AS x, 'like_rate' AS y,
 CAST(floor(log10(view_count) / 0.1::DOUBLE) AS INTEGER) AS x_cell,
 CAST(floor(log10(like_rate) / 0.1::DOUBLE) AS INTEGER) AS y_cell, count(*) AS n
FROM clusters WHERE view_count > 0 AND like_rate > 0 GROUP BY ALL""")
def cluster_density(spark, sf):
    """All points of the two-dimensional cluster view, counted per cell."""
    return distributions.pair_density(
        rule_clusters(spark, sf), [("view_count", "like_rate")], 0.1, ["prediction"])


@query()
def kmeans_assign(spark, sf):
    return clustering.assign_clusters(part_peaks(spark, sf), "video_id", PREDICTORS, 4)


@query()
def elbow(spark, sf):
    return clustering.elbow(part_peaks(spark, sf), "video_id")


@query()
def kmeans_sweep(spark, sf):
    assignments, _ = clustering.cluster_sweep(part_peaks(spark, sf), "video_id")
    return reshape.stack_tagged(
        {key: clustering.cluster_sizes(rows) for key, rows in assignments.items()}, "key")


@query()
def wcss_summary(spark, sf):
    return clustering.cluster_sweep(part_peaks(spark, sf), "video_id")[1]


# Groups so far apart that K-means must find them: sizes, profile and cost follow in SQL.
GROUPS = "(p_size % 10) / 10::DOUBLE"
GROUPED_SQL = f"""grouped AS (SELECT p_partkey AS video_id, CAST(p_partkey % 4 AS INTEGER) AS grp,
  {", ".join(f"{a} AS {name}" for name, a in zip(EXTENDED_PREDICTORS, [
      f"100::DOUBLE * (p_partkey % 2) + {GROUPS}", f"100::DOUBLE * (p_partkey % 4 // 2) + {GROUPS}"] * 4))} FROM part)"""


def cost_sql(features) -> str:
    """Sum of squared standardised distances to the group means."""
    parts = " + ".join(f"sum(power(({c} - m_{c}) / s_{c}, 2))" for c in features)
    means = ", ".join(f"avg({c}) OVER (PARTITION BY grp) AS m_{c}, stddev_samp({c}) OVER () AS s_{c}" for c in features)
    return f"(SELECT round({parts}, 2) FROM (SELECT *, {means} FROM grouped))"


FOUR_GROUPS = tuple(s for s in clustering.CLUSTER_SCENARIOS if s.k == 4)


@query(f"WITH {GROUPED_SQL} SELECT grp, count(*) AS n FROM grouped GROUP BY grp")
def kmeans_groups(spark, sf):
    """Each group is one cluster: a group that K-means split or joined would show."""
    assigned = clustering.assign_clusters(grouped_parts(spark, sf), "video_id", PREDICTORS, 4, keep=["grp"])
    groups = rollup.group_counts(assigned, ["grp", "prediction"])
    clusters = groups.groupBy("prediction").agg(F.count(F.lit(1)).alias("groups"))
    return groups.join(clusters.filter("groups = 1"), "prediction", "left_semi").select("grp", "n")


@query(f"WITH {GROUPED_SQL} SELECT 4 AS k, {cost_sql(PREDICTORS)} AS wcss")
def elbow_groups(spark, sf):
    return round_columns(clustering.elbow(grouped_parts(spark, sf), "video_id", ks=(4,)), ["wcss"], 2)


def far_groups_sql(k: int) -> str:
    """Squared standardised distances to the means of ``k`` far groups."""
    return f"""SELECT {k} AS k, round(sum(power((x - m) / s, 2)), 2) AS wcss FROM (
      SELECT x, avg(x) OVER (PARTITION BY grp) AS m, stddev_samp(x) OVER () AS s FROM (
        SELECT p_partkey % {k} AS grp, 1000::DOUBLE * (p_partkey % {k}) + p_size AS x FROM part))"""


@query(" UNION ALL ".join(map(far_groups_sql, clustering.ELBOW_K)))
def elbow_each_k(spark, sf):
    """For every k of the sweep, the cost of k groups that K-means must find."""
    parts = table(spark, sf, "part")
    return round_columns(reshape.stack([
        clustering.elbow(parts.selectExpr("p_partkey as video_id", f"1000D * (p_partkey % {k}) + p_size as x"), "video_id", ["x"], ks=(k,))
        for k in clustering.ELBOW_K]), ["wcss"], 2)


@query(f"WITH {GROUPED_SQL} " + " UNION ALL ".join(
    f"SELECT '{s.key}' AS key, '{s.name}' AS scenario, {s.k} AS k, '{s.feature_set}' AS feature_set, "
    f"{cost_sql(clustering.FEATURE_SETS[s.feature_set])} AS wcss" for s in FOUR_GROUPS))
def wcss_groups(spark, sf):
    return clustering.cluster_sweep(grouped_parts(spark, sf), "video_id", FOUR_GROUPS)[1]


@query(f"WITH {GROUPED_SQL} " + " UNION ALL ".join(
    f"SELECT '{s.key}' AS key, count(*) AS n, " + ", ".join(
        f"round(avg({c}), 6) AS {c}" for c in EXTENDED_PREDICTORS) + " FROM grouped GROUP BY grp" for s in FOUR_GROUPS))
def saved_clusters(spark, sf):
    """A saved and reloaded clustering study: sizes and means of every scenario's clusters."""
    rows = grouped_parts(spark, sf)
    assignments, summary = clustering.cluster_sweep(rows, "video_id", FOUR_GROUPS)
    folder = new_path(spark, "clusters")
    clustering.save_clusters(folder, clustering.elbow(rows, "video_id", ks=(4,)), summary, assignments)
    overview = clustering.load_clusters(spark, folder)["overview"].drop("prediction")
    return round_columns(overview, EXTENDED_PREDICTORS, 6)


@query(f"""WITH {PREPARED_SQL}, counted AS (SELECT category_name FROM prepared WHERE category_name IS NOT NULL
  GROUP BY 1 HAVING count(*) >= {MIN_SAMPLES}),
usable AS (SELECT *, video_id || '|' || category_id AS key FROM prepared JOIN counted USING (category_name))
SELECT CASE WHEN {unit_sql('key', '42:split')} < 0.8 THEN 'training' ELSE 'test' END AS part,
  CAST(floor({unit_sql('key', '42:fold')} * 3) AS INTEGER) AS fold, count(*) AS n FROM usable GROUP BY ALL""")
def composite_key_split(spark, sf):
    """Rows of the preparation are one per item and category, so both columns decide part and fold."""
    data = classification.modelling_table(
        prepare_trending(spark, sf), ["video_id", "category_id"], "category_name", min_samples=MIN_SAMPLES)
    return rollup.group_counts(data, ["part", "fold"])
