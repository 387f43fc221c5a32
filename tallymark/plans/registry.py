"""Every query of the library over the driver's tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import FIVE_BANDS, FOUR_BANDS, bucketize
from tallymark.operators import (
    colocated_join,
    count_by,
    distinct_totals,
    lookup,
    read_clustered,
    read_means,
    revenue_by_lookup,
    update_means,
    with_places,
    write_clustered,
    write_colocated,
)
from tallymark.plans import movies as m
from tallymark.plans import reports
from tallymark.plans import reviews as r
from tallymark.plans import shop as s
from tallymark.plans import tables as t
from tallymark.session import scratch_path
from tallymark.sources import (
    delimited_lines,
    parse_delimited,
    read_csv,
    read_csv_columns,
    reject_lines,
    write_delimited,
    write_text,
)
from tallymark.streaming import (
    CORRUPT,
    ingest_ndjson,
    ingest_to_sinks,
    parse_ndjson,
    read_ndjson_stream,
    read_sink,
    to_ndjson,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
#: Sums go in hundredths; a value with more decimals fails the query, see `summable`.
SCALE = 2


def _with_ts_text(df):
    """Timestamps as text, to the second: both engines write them alike."""
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _placed(df):
    """Add `place`, the number of the row in the order that the query gives."""
    return with_places(df).withColumn("place", F.col("place").cast("int"))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- ratings ---------------------------------------------------------------------------------


@query
def rating_summary(spark, d):
    return m.movie_averages(t.item_ratings(spark, d), t.movies(spark, d), SCALE)


@query
def rating_summary_unmatched(spark, d):
    return m.movie_averages(t.event_ratings(spark, d), t.nation_titles(spark, d), SCALE)


@query
def best_with_min_support(spark, d):
    return m.best_movie(t.item_ratings(spark, d), t.movies(spark, d), 5, SCALE)


@query
def avg_by_multivalue(spark, d):
    return m.genre_averages(t.item_ratings(spark, d), t.movies(spark, d), " ", SCALE)


@query
def conditional_avg_pair(spark, d):
    labels = {"male": "machinery", "female": "furniture"}
    ratings = t.user_ratings(spark, d)
    return m.gender_averages_wide(ratings, t.movies(spark, d), t.users(spark, d), labels, SCALE)


@query
def bucketed_avg_wide(spark, d):
    ratings = t.user_ratings(spark, d)
    return m.age_band_averages_wide(ratings, t.movies(spark, d), t.users(spark, d), SCALE)


@query
def bucketed_avg_unrated(spark, d):
    """Customers as the rated, events as their ratings: most customers have none."""
    events = t.table(spark, d, "events").select(
        F.col("event_id").alias("user_id"),
        F.col("user_id").alias("movie_id"),
        F.col("value").alias("rating"),
    )
    raters = t.table(spark, d, "events").select(
        F.col("event_id").alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("age"),
    )
    titles = t.table(spark, d, "customer").select(
        F.col("c_custkey").alias("movie_id"), F.col("c_name").alias("title")
    )
    return m.age_band_averages_wide(events, titles, raters, SCALE)


@query
def summary_agg_then_join(spark, d):
    return m.movie_averages_known(t.event_ratings(spark, d), t.nation_titles(spark, d), SCALE)


@query
def avg_by_item_and_group(spark, d):
    ratings = t.user_ratings(spark, d)
    return m.gender_averages_long(ratings, t.movies(spark, d), t.users(spark, d), SCALE)


@query
def relabelled_groups(spark, d):
    """Users per spelled-out label: one value becomes Male, any other Female."""
    users = t.users(spark, d).replace({"MACHINERY": "M"}, subset=["gender"])
    return count_by(m.gender_names(users), "gender", "user_id")


@query
def report_lines(spark, d):
    ratings = t.user_ratings(spark, d)
    means = m.gender_averages_long(ratings, t.movies(spark, d), t.users(spark, d), SCALE)
    return reports.gender_lines(means, ["movie_id"])


@query
def first_report_rows(spark, d):
    ratings = t.user_ratings(spark, d)
    means = m.age_band_averages_long(ratings, t.movies(spark, d), t.users(spark, d), SCALE)
    return reports.age_band_lines(m.first_rows(means, ["movie_id", "band"]), ["movie_id"])


@query
def avg_by_item_and_band(spark, d):
    ratings = t.user_ratings(spark, d)
    return m.age_band_averages_long(ratings, t.movies(spark, d), t.users(spark, d), SCALE)


@query
def users_by_band(spark, d):
    """Users per band of the four-band and of the five-band age scale."""
    age = F.col("age")
    banded = t.users(spark, d).select(
        "user_id",
        bucketize(age, *FOUR_BANDS).alias("four"),
        bucketize(age, *FIVE_BANDS).alias("five"),
    )
    return count_by(banded, ["four", "five"], "user_id")


@query
def summary_by_code(spark, d):
    return m.occupation_averages(t.user_ratings(spark, d), t.users(spark, d), SCALE)


@query
def summary_by_code_name(spark, d):
    ratings = t.user_ratings(spark, d)
    return m.occupation_averages_named(
        ratings, t.users(spark, d), t.occupations(spark, d), SCALE
    )


@query
def lookup_unmatched(spark, d):
    """Events with the name of their code, null where the code has none."""
    return lookup(
        t.event_ratings(spark, d), t.nation_titles(spark, d), "movie_id", ["title"], "left", True
    )


@query
def lookup_isolated(spark, d):
    """The same where hot codes and events without one are found first and dealt to many tasks."""
    events, titles = t.event_ratings(spark, d), t.nation_titles(spark, d)
    return lookup(events, titles, "movie_id", ["title"], "left", True, isolate=True)


@query
def conditional_avg_isolated(spark, d):
    """Means per item of two groups of users, hot users split."""
    labels = {"male": "machinery", "female": "furniture"}
    ratings = t.user_ratings(spark, d)
    return m.gender_averages_wide(
        ratings, t.movies(spark, d), t.users(spark, d), labels, SCALE, isolate=True
    )


@query
def bucketed_avg_isolated(spark, d):
    """Means per item and band, hot users split and shared item keys combined before the shuffle."""
    ratings = t.user_ratings(spark, d)
    return m.age_band_averages_wide(ratings, t.movies(spark, d), t.users(spark, d), SCALE, isolate=True)


@query
def summary_by_epoch_year(spark, d):
    return m.year_averages(t.epoch_ratings(spark, d), SCALE)


# ---- report lines ----------------------------------------------------------------------------


@query
def movie_average_report(spark, d):
    return reports.movie_average_lines(rating_summary(spark, d))


@query
def movie_average_report_ordered(spark, d):
    """The lines in the order of a text key: byte by byte."""
    means = rating_summary(spark, d).withColumn("movie_id", F.col("movie_id").cast("string"))
    return _placed(reports.movie_average_lines(means))


@query
def best_movie_report(spark, d):
    return reports.best_movie_lines(best_with_min_support(spark, d), 5)


@query
def gender_wide_report(spark, d):
    """0.00 stands for a mean without ratings."""
    wide = conditional_avg_pair(spark, d)
    return reports.gender_wide_lines(wide)


@query
def age_band_wide_report(spark, d):
    """NA stands for a mean without ratings."""
    return reports.age_band_wide_lines(bucketed_avg_unrated(spark, d))


@query
def movie_average_blocks(spark, d):
    return reports.movie_average_blocks(summary_agg_then_join(spark, d))


@query
def gender_blocks(spark, d):
    """The first 20 rows, relabelled: one value becomes Male, any other Female."""
    users = t.users(spark, d).replace({"MACHINERY": "M"}, subset=["gender"])
    ratings = t.user_ratings(spark, d)
    means = m.gender_averages_long(ratings, t.movies(spark, d), users, SCALE)
    first = m.first_rows(means, ["movie_id", "gender"])
    return _placed(reports.gender_blocks(m.gender_names(first)))


@query
def gender_report_first(spark, d):
    users = t.users(spark, d).replace({"MACHINERY": "M"}, subset=["gender"])
    ratings = t.user_ratings(spark, d)
    means = m.gender_averages_long(ratings, t.movies(spark, d), users, SCALE)
    first = m.first_rows(means, ["movie_id", "gender"])
    return _placed(reports.gender_lines(m.gender_names(first)))


@query
def genre_report(spark, d):
    return _placed(reports.genre_lines(avg_by_multivalue(spark, d)))


@query
def occupation_report(spark, d):
    return _placed(reports.occupation_lines(summary_by_code(spark, d)))


@query
def year_report(spark, d):
    return _placed(reports.year_lines(summary_by_epoch_year(spark, d)))


# ---- review text -----------------------------------------------------------------------------


def _part_words(spark, d):
    return t.table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word"))


@query
def clean_tokens(spark, d):
    return r.clean_words(t.reviews(spark, d), t.STOPWORDS, t.DELIMS)


@query
def clean_tokens_stopword_table(spark, d):
    """Stopwords from a table: the words of the part names, each as often as parts have it."""
    return r.clean_words(t.reviews(spark, d), _part_words(spark, d), t.DELIMS)


@query
def clean_tokens_filtered(spark, d):
    """The same by a broadcast filter of the table: no word is shuffled."""
    return r.clean_words(t.reviews(spark, d), _part_words(spark, d), t.DELIMS, filtered=True)


@query
def word_counts(spark, d):
    return r.word_counts(t.reviews(spark, d), t.STOPWORDS, t.DELIMS)


@query
def word_counts_stopword_table(spark, d):
    return r.word_counts(t.reviews(spark, d), _part_words(spark, d), t.DELIMS)


@query
def top_words(spark, d):
    return r.top_words(t.reviews(spark, d), t.STOPWORDS, 5, t.DELIMS)


@query
def top_words_cut(spark, d):
    """The same, counting only words that a sketch says may be among the five."""
    return r.top_words(t.reviews(spark, d), t.STOPWORDS, 5, t.DELIMS, cut=True)


@query
def top_words_by_category_cut(spark, d):
    """The five commonest words per category by the same cut, stopwords from the table of part names."""
    words = _part_words(spark, d)
    return r.top_words_by_category(t.reviews(spark, d), words, None, 5, t.DELIMS, cut=True)


@query
def count_by_category(spark, d):
    return r.comments_by(t.reviews(spark, d), "category")


@query
def count_by_aspect(spark, d):
    return r.comments_by(t.reviews(spark, d), "aspect")


@query
def top_negative_aspect(spark, d):
    return r.leading_aspect(t.felt_reviews(spark, d), "negative")


@query
def top_positive_aspect(spark, d):
    return r.leading_aspect(t.felt_reviews(spark, d), "positive")


@query
def top_positive_words_by_category(spark, d):
    felt = t.felt_reviews(spark, d)
    return r.top_words_by_category(felt, t.STOPWORDS, "positive", 5, t.DELIMS)


@query
def top_negative_words_by_category(spark, d):
    felt = t.felt_reviews(spark, d)
    return r.top_words_by_category(felt, t.STOPWORDS, "negative", 5, t.DELIMS)


@query
def top_words_by_category(spark, d):
    return r.top_words_by_category(t.reviews(spark, d), t.STOPWORDS, None, 5, t.DELIMS)


# ---- shop ------------------------------------------------------------------------------------


@query
def totals(spark, d):
    return s.totals(t.shop_orders(spark, d), t.shop_items(spark, d))


@query
def distinct_in_one_scan(spark, d):
    """Distinct customers, days and order numbers of all orders, nulls not counted."""
    orders = t.table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    wanted = {"customers": "o_custkey", "days": "day", "orders": "o_orderkey"}
    return distinct_totals(orders, wanted, count_null=False, rows="rows")


@query
def orders_by_country(spark, d):
    return s.orders_by_country(t.shop_orders(spark, d), t.shop_customers(spark, d))


@query
def orders_by_month(spark, d):
    return s.orders_by_month(t.shop_orders(spark, d))


@query
def orders_by_month_ordered(spark, d):
    return _placed(orders_by_month(spark, d))


@query
def orders_by_country_ordered(spark, d):
    return _placed(orders_by_country(spark, d))


@query
def category_revenue_ordered(spark, d):
    return _placed(category_revenue_in_year(spark, d))


@query
def score_distribution(spark, d):
    return s.score_distribution(t.shop_scores(spark, d))


@query
def average_score(spark, d):
    return s.average_score(t.shop_scores(spark, d))


@query
def score_report(spark, d):
    """The report's lines and their places."""
    return _placed(reports.score_lines(s.score_summary(t.shop_scores(spark, d))))


@query
def category_revenue_in_year(spark, d):
    return s.category_revenue(
        t.shop_orders(spark, d), t.shop_items(spark, d), t.shop_products(spark, d), 1997
    )


@query
def category_revenue_isolated(spark, d):
    """The same where orders with very many lines are found first and split."""
    orders, items = t.shop_orders(spark, d), t.shop_items(spark, d)
    return s.category_revenue(orders, items, t.shop_products(spark, d), 1997, isolate=True)


@query
def category_revenue_colocated(spark, d):
    """The same over order lines and orders written in buckets of the order: joined without a shuffle."""
    base, name = scratch_path(spark, "colocated"), f"shop_{uuid.uuid4().hex}"
    orders = t.shop_orders(spark, d).withColumnRenamed("order_purchase_timestamp", "moment")
    write_colocated(t.shop_items(spark, d), {"orders": orders}, "order_id", name, base, 16)
    in_1997 = (F.col("moment") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (
        F.col("moment") < F.lit("1998-01-01").cast("timestamp_ntz")
    )
    sold = colocated_join(spark, name, "orders", "order_id", where=in_1997)
    products = t.shop_products(spark, d)
    return revenue_by_lookup(sold, products, "product_id", "product_category_name", "price", "freight_value")


@query
def orders_by_month_clustered(spark, d):
    """Orders of 1997 per month, of files laid out by time and customer: most are never opened."""
    path = scratch_path(spark, "clustered")
    write_clustered(t.shop_orders(spark, d), path, ["order_purchase_timestamp", "customer_trx_id"], 32)
    year = (datetime(1997, 1, 1), datetime(1998, 1, 1))
    orders = read_clustered(spark, path, {"order_purchase_timestamp": year})
    return s.orders_by_month(orders)


@query
def revenue_many_decimals(spark, d):
    """Revenue per seller of prices with four decimals, as DECIMAL: rounded after the sum only."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    rest = 1 - F.col("l_discount").cast("decimal(18,2)")
    items = t.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_orderkey").alias("order_id"),
        (price * rest).alias("price"),
        (price * F.col("l_tax").cast("decimal(18,2)")).alias("freight_value"),
    )
    return s.seller_stats(items)


@query
def fanout_pair_stats(spark, d):
    return s.product_stats(t.items_by_seller(spark, d), t.shop_scores(spark, d))


@query
def seller_stats(spark, d):
    return s.seller_stats(t.shop_items(spark, d))


@query
def seller_stats_ordered(spark, d):
    return _placed(seller_stats(spark, d))


@query
def seller_stats_text_orders(spark, d):
    """Order numbers as text, counted through a dictionary."""
    order = F.concat(F.lit("order "), F.col("order_id").cast("string"))
    return s.seller_stats(t.shop_items(spark, d).withColumn("order_id", order), dictionary=True)


# ---- text and JSON in and out ----------------------------------------------------------------


@query
def delimited_lenient(spark, d):
    pick = ["user_id", "movie_id", "rating"]
    lines = t.rating_lines(spark, d)
    return parse_delimited(lines, m.RATINGS, pick=pick, **m.READING["lenient"])


@query
def delimited_trimmed(spark, d):
    """Blanks around every field, short lines dropped, no bad number among the rest."""
    padded = t.rating_lines(spark, d).select(
        F.concat(F.lit("\t "), F.replace("value", F.lit(","), F.lit(" , ")), F.lit(" \r")).alias(
            "value"
        )
    )
    schema = "user_id string, movie_id string, rating string, ts bigint"
    return parse_delimited(padded, schema, **m.READING["trimmed"])


@query
def delimited_strict(spark, d):
    lines = t.rating_lines(spark, d, damaged=False)
    schema = "user_id bigint, movie_id bigint, rating double, ts bigint"
    return parse_delimited(lines, schema, **m.READING["exact"])


@query
def delimited_rejects(spark, d):
    return reject_lines(
        t.rating_lines(spark, d), m.RATINGS, pick=["user_id", "movie_id", "rating"], trim=False
    )


@query
def delimited_declared(spark, d):
    """All documents as review lines; some lack the id, some a known sentiment."""
    return r.known_reviews(parse_delimited(t.review_lines(spark, d), r.REVIEWS, **r.READING))


def _two_parts():
    """Conditions that part the order lines in two, whatever their status."""
    finished = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    return finished, ~finished


@query
def union_inputs(spark, d):
    lines = t.table(spark, d, "lineitem")
    halves = [
        lines.filter(part).select(
            F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
        )
        for part in _two_parts()
    ]
    return m.movie_averages(halves[0].unionByName(halves[1]), t.movies(spark, d), SCALE)


@query
def ratings_from_files(spark, d):
    """Two rating files and a movie file written as text, read back by glob, and summarised."""
    base = scratch_path(spark, "ratings")
    lines = t.table(spark, d, "lineitem")
    for n, part in enumerate(_two_parts(), 1):
        rows = lines.filter(part).select("l_orderkey", "l_partkey", "l_quantity", F.lit("0"))
        write_delimited(rows, f"{base}/ratings_{n}", ",")
    write_delimited(t.movies(spark, d), f"{base}/movies", ",")
    ratings = m.load_ratings(spark, f"{base}/ratings_*", "strict")
    titles = m.load_movies(spark, f"{base}/movies", "exact")
    return m.movie_averages_known(ratings, titles, SCALE)


@query
def incremental_means(spark, d):
    """Order lines as rating files that arrive in three parts; each run reads the new files only."""
    base = scratch_path(spark, "growing")
    lines = t.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", F.lit("0"))
    for n in range(3):
        part = lines.filter(F.pmod(F.xxhash64("l_orderkey", "l_partkey"), F.lit(3)) == n)
        write_delimited(part, f"{base}/in/part{n}", ",")
        files = f"{base}/in/*"
        update_means(
            spark, f"{base}/state", files, lambda s, p: m.load_ratings(s, p, "strict"), "movie_id", "rating", SCALE
        )
    return read_means(spark, f"{base}/state", "movie_id", SCALE)


def _with_date_text(df):
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query
def csv_with_header(spark, d):
    """Orders written as semicolon CSV with a header, read back with inferred types."""
    path = scratch_path(spark, "orders-csv")
    orders = t.table(spark, d, "orders")
    orders.write.option("sep", ";").option("header", True).csv(path)
    read = read_csv(spark, path)
    kinds = {f.name: f.dataType for f in orders.schema}
    typed = read.select(*[F.col(c).cast(kinds[c]).alias(c) for c in orders.columns])
    return _with_date_text(typed)


@query
def csv_with_schema(spark, d):
    """The same under a declared schema."""
    path = scratch_path(spark, "orders-csv")
    orders = t.table(spark, d, "orders")
    orders.write.option("sep", ";").option("header", True).csv(path)
    return _with_date_text(read_csv(spark, path, schema=orders.schema))


@query
def csv_columns_by_name(spark, d):
    """Some columns under declared types, found by the header."""
    path = scratch_path(spark, "orders-csv")
    t.table(spark, d, "orders").write.option("sep", ";").option("header", True).csv(path)
    columns = "O_OrderDate timestamp_ntz, O_OrderKey bigint, O_TotalPrice decimal(18,2)"
    read = read_csv_columns(spark, path, columns)
    return _with_date_text(
        read.select(
            F.col("O_OrderKey").alias("o_orderkey"),
            F.col("O_TotalPrice").cast("double").alias("o_totalprice"),
            F.col("O_OrderDate").alias("o_orderdate"),
        )
    )


@query
def csv_mixed_headers(spark, d):
    """All orders in files of three layouts: other orders of the columns, one column more, one less."""
    base = scratch_path(spark, "orders-mixed")
    orders = t.table(spark, d, "orders")
    names, turn = orders.columns, F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    layouts = [names, [c.upper() for c in reversed(names)] + ["note"], sorted(names[:-1])]
    for n, columns in enumerate(layouts):
        part = orders.withColumn("note", F.lit("x")).filter(turn == n).select(*columns)
        part.write.option("sep", ";").option("header", True).csv(f"{base}/part={n}")
    kinds = "o_orderkey bigint, o_orderdate timestamp_ntz, o_custkey bigint, o_orderstatus string, o_totalprice double"
    return _with_date_text(read_csv_columns(spark, f"{base}/*", kinds))


@query
def text_sink(spark, d):
    """Genre report lines written as key, tab, value, and read back."""
    path = scratch_path(spark, "genres")
    means = m.genre_averages(t.item_ratings(spark, d), t.movies(spark, d), " ", SCALE)
    write_text(reports.genre_lines(means), path)
    return spark.read.text(path)


@query
def delimited_sink(spark, d):
    """Word counts per category written with semicolons, and read back."""
    path = scratch_path(spark, "words")
    top = r.top_words_by_category(t.reviews(spark, d), t.STOPWORDS, None, 5, t.DELIMS)
    write_delimited(top, path)
    return spark.read.text(path)


@query
def delimited_encode(spark, d):
    return delimited_lines(
        _with_date_text(t.table(spark, d, "orders")).select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
        )
    )


def _event_lines(spark, d):
    return to_ndjson(t.table(spark, d, "events").select(*EVENT_COLUMNS))


@query
def ndjson_parse(spark, d):
    return _with_ts_text(parse_ndjson(_event_lines(spark, d), EVENT_SCHEMA))


@query
def ndjson_rejects(spark, d):
    """Lines cut short wherever the event is an error: they come back whole as rejects."""
    events = t.table(spark, d, "events").select(*EVENT_COLUMNS)
    whole = to_ndjson(events.filter(F.col("event_type") != "error"))
    cut = events.filter(F.col("event_type") == "error").select(
        F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":')).alias("value")
    )
    parsed = parse_ndjson(whole.unionByName(cut), EVENT_SCHEMA)
    return _with_ts_text(parsed.withColumnRenamed(CORRUPT, "reject"))


@query
def ndjson_stream(spark, d):
    """Events as JSON lines in two folders, streamed to parquet, and read back.

    Error events are cut short in the second folder, and a blank line follows each of them.
    """
    base = scratch_path(spark, "events")
    events = t.table(spark, d, "events").select(*EVENT_COLUMNS)
    is_error = F.coalesce(F.col("event_type") == "error", F.lit(False))
    to_ndjson(events.filter(~is_error)).write.text(f"{base}/in_1")
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'))
    lines = events.filter(is_error).select(F.explode(F.array(cut, F.lit("  "))).alias("value"))
    lines.write.text(f"{base}/in_2")
    stream = read_ndjson_stream(spark, [f"{base}/in_1", f"{base}/in_2"], EVENT_SCHEMA)
    ingest_ndjson(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    back = spark.read.parquet(f"{base}/out")
    return _with_ts_text(back.select(*EVENT_COLUMNS, F.col(CORRUPT).alias("reject"), "kind"))


@query
def ndjson_sinks(spark, d):
    """The same two folders into a sink of rows, one of rejects and one of counts, a batch for each file at most."""
    base = scratch_path(spark, "events")
    events = t.table(spark, d, "events").select(*EVENT_COLUMNS)
    is_error = F.coalesce(F.col("event_type") == "error", F.lit(False))
    to_ndjson(events.filter(~is_error)).write.text(f"{base}/in_1")
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'))
    events.filter(is_error).select(cut.alias("value")).write.text(f"{base}/in_2")
    for folders in ([f"{base}/in_1"], [f"{base}/in_2"]):
        stream = read_ndjson_stream(spark, folders, EVENT_SCHEMA, max_files=4)
        name = folders[0].rsplit("_", 1)[1]
        ingest_to_sinks(stream, f"{base}/out{name}", f"{base}/checkpoint{name}").awaitTermination()

    def sink(name):
        return read_sink(spark, f"{base}/out1", name).union(read_sink(spark, f"{base}/out2", name))

    rows, rejects = sink("good").select(F.lit("good").alias("sink"), "event_id"), sink("bad")
    whole = F.regexp_extract("value", "[0-9]+", 0).cast("bigint")
    counts = sink("counts").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    both = F.inline(F.array(*[F.struct(F.lit(f"{n} rows").alias("sink"), F.col(n).alias("event_id")) for n in ("good", "bad")]))
    return rows.union(rejects.select(F.lit("bad"), whole)).union(counts.select(both))
