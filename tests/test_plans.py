"""The physical plans: what is read, shuffled, cut early, and split when skewed."""

import contextlib
import io
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import drop_stopwords, lookup
from tallymark.plans import movies as m
from tallymark.plans import shop, tables
from tallymark.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
WRITES_FILES = {
    "ratings_from_files", "csv_with_header", "csv_with_schema", "text_sink", "delimited_sink",
    "ndjson_stream", "csv_columns_by_name", "csv_mixed_headers", "incremental_means",
    "ndjson_sinks", "category_revenue_colocated", "orders_by_month_clustered",
}
PLACED = {
    "score_report", "gender_blocks", "gender_report_first", "genre_report", "occupation_report",
    "year_report", "orders_by_month_ordered", "orders_by_country_ordered",
    "category_revenue_ordered", "seller_stats_ordered", "movie_average_report_ordered",
}


def plan(df, mode="simple") -> str:
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()


def formatted(df) -> str:
    return plan(df, "formatted")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FILES))
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval"):
        assert node not in text
    windows = re.findall(r"Window \[.*", text)
    if name in PLACED:  # the last window adds up the rows of each task: one row a task
        assert "[sum(_n#" in windows[0] and "_task#" in windows[0]
        windows = windows[1:]
    assert all(re.search(r"\], \[\w+#\d+L?\], \[", w) for w in windows)


# Hash exchanges of each plan: one for each input of a join or grouping by another key.
TITLED = {
    "rating_summary": 2, "best_with_min_support": 3, "conditional_avg_pair": 6,
    "bucketed_avg_wide": 6, "bucketed_avg_unrated": 4, "lookup_unmatched": 2,
    "summary_by_code_name": 6,
}


@pytest.mark.parametrize("name", TITLED)
def test_a_dimension_is_shuffled_once_by_its_key(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning") == TITLED[name]


def test_each_table_is_scanned_once(spark):
    assert plan(QUERIES["totals"](spark, FOLDER)).count("FileScan") == 2
    # The report itself numbers lines that are written first.
    assert plan(shop.score_summary(tables.shop_scores(spark, FOLDER))).count("FileScan") == 1


def test_salted_stopwords_split_a_hot_word(split_early):
    spark = split_early
    words = spark.range(0, 40_000, numPartitions=8).select(F.lit("the").alias("word"), "id")
    table = spark.createDataFrame([("a",), ("b",)], "w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = drop_stopwords(words, table, salts=8)
        assert kept.groupBy(F.spark_partition_id()).count().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("rating_summary", {"l_partkey", "l_quantity", "p_partkey", "p_name"}),
        ("orders_by_month", {"o_orderdate"}),
        ("count_by_aspect", {"doc_id", "source"}),
        ("top_words", {"doc_id", "text"}),
        ("top_negative_aspect", {"doc_id", "source", "quality", "toxic"}),
        ("totals", {"o_custkey", "l_suppkey"}),
    ],
)
def test_reads_only_the_columns_it_needs(spark, name, columns):
    text = formatted(QUERIES[name](spark, FOLDER))
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*)>", text))))
    assert read == columns


def test_year_filter_reaches_the_scan(spark):
    text = formatted(QUERIES["category_revenue_in_year"](spark, FOLDER))
    pushed = next(p for p in re.findall(r"PushedFilters: \[(.*)\]", text) if "o_orderdate" in p)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_top_rows_are_cut_in_each_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_words"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan(QUERIES["best_with_min_support"](spark, FOLDER))
    assert plan(QUERIES["top_words_by_category"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_words_are_made_without_a_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["clean_tokens"](spark, FOLDER))
    assert "Exchange" not in plan(QUERIES["delimited_lenient"](spark, FOLDER))


def test_each_line_is_split_once(spark):
    text = formatted(QUERIES["delimited_lenient"](spark, FOLDER))
    assert text.count("split(") == 1 and text.count("try_cast(") == 1


def test_groups_shrink_before_the_shuffle(spark):
    for name in ("rating_summary", "summary_by_code", "word_counts", "seller_stats"):
        assert "partial_" in plan(QUERIES[name](spark, FOLDER))


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def split_early(spark):
    before = {k: spark.conf.get(k) for k in SPLIT_EARLY}
    for key, value in SPLIT_EARLY.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "query",
    [
        m.gender_averages_wide,
        m.age_band_averages_wide,
        m.gender_averages_long,
        m.age_band_averages_long,
    ],
)
def test_a_hot_user_is_split_over_tasks(split_early, query):
    spark = split_early
    ids = spark.range(0, 60_000, numPartitions=8)
    ratings = ids.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("user_id"),
        (F.col("id") * 7 % 500).alias("movie_id"),
        (F.col("id") % 10 / 2).alias("rating"),
    )
    users = spark.range(1000).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"),
        (F.col("id") % 80).cast("int").alias("age"),
    )
    movies = spark.range(500).select(
        F.col("id").alias("movie_id"), F.concat(F.lit("m"), F.col("id")).alias("title")
    )
    hot = query(ratings, movies, users)
    found = rows(hot)
    assert "skew=true" in plan(hot)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert rows(query(ratings, movies, users)) == found
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_salts_split_copies_of_one_row(split_early):
    spark = split_early
    copies = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") >= 0, 7).alias("user_id"), F.lit("x").alias("what")
    )
    users = spark.range(10).select(F.col("id").alias("user_id"), F.lit("M").alias("gender"))

    def tasks(df):
        return df.groupBy(F.spark_partition_id()).count().count()

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert tasks(lookup(copies, users, "user_id", ["gender"])) == 1
        assert tasks(lookup(copies, users, "user_id", ["gender"], salts=8)) > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_aggregated_joins_see_a_hot_key_once(split_early):
    spark = split_early
    ratings = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("user_id"),
        F.lit(4.0).alias("rating"),
    )
    users = spark.range(1000).select(
        F.col("id").alias("user_id"), (F.col("id") % 15).alias("occupation")
    )
    text = plan(m.occupation_averages(ratings, users))
    join = text.index("Join [user_id")
    assert "HashAggregate(keys=[user_id" in text[join:]
