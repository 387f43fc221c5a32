"""The shop's star schema bound to the inputs of the movie, review and shop queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.dates import SECONDS_PER_DAY
from tallymark.operators import pinned

# Function words of the four languages of the documents, and characters that part
# words there besides the usual ones.
STOPWORDS = (
    "der", "die", "das", "und", "ist", "in", "den", "von", "zu", "mit",
    "the", "of", "and", "to", "is", "that", "for", "with", "as", "by",
    "el", "la", "los", "las", "de", "que", "y", "en", "un", "por",
    "le", "les", "des", "et", "du", "une", "qui", "dans", "pour", "sur",
)
DELIMS = ' ",()*\n\t\r'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def item_ratings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
    )


def user_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Each order line as its customer's rating of the part."""
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
    )


def movies(spark: SparkSession, d: str) -> DataFrame:
    """Parts; the words of the name stand for genres."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"),
    )


def users(spark: SparkSession, d: str) -> DataFrame:
    """Customers; a hundredth of the balance, -9 to 99, stands for the age."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("gender"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"),
        F.col("c_nationkey").alias("occupation"),
    )


def occupations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("occupation"), F.col("n_name").alias("name")
    )


def event_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Events as ratings of the code `k` in their properties, which only some nations have."""
    code = F.get_json_object("props", "$.k").try_cast("int")
    events = table(spark, d, "events").select("props", F.col("value").alias("rating"))
    return pinned(events, movie_id=code).drop("props")


def nation_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("movie_id"), F.col("n_name").alias("title")
    )


def reviews(spark: SparkSession, d: str) -> DataFrame:
    """Documents as reviews: language as category, source as aspect."""
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("review"),
        F.col("source").alias("aspect"),
        F.col("lang").alias("category"),
        F.lit("neutral").alias("sentiment"),
    )


def felt_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The same for labelled documents, with the label as sentiment."""
    felt = table(spark, d, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
        .alias("sentiment"),
    )
    return reviews(spark, d).drop("sentiment").join(felt, "id")


def shop_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_trx_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def shop_items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
    )


def shop_products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def shop_customers(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation")
    customers = table(spark, d, "customer")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_trx_id"), F.col("n_name").alias("customer_country")
    )


def shop_scores(spark: SparkSession, d: str) -> DataFrame:
    """Events as reviews; `k` of the properties, 0 to 99, stands for the score."""
    events = table(spark, d, "events").select("props", F.col("user_id").alias("order_id"))
    return pinned(events, review_score=F.get_json_object("props", "$.k")).drop("props")


def items_by_seller(spark: SparkSession, d: str) -> DataFrame:
    """Items keyed by seller, a key that many items and many reviews share."""
    return shop_items(spark, d).select(F.col("seller_id").alias("order_id"), "product_id")


def epoch_text(moment: str) -> Column:
    """Epoch seconds, as text, of a timestamp without a zone."""
    days = F.date_diff(F.col(moment).cast("date"), F.lit("1970-01-01").cast("date"))
    clock = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return (days.cast("bigint") * SECONDS_PER_DAY + clock).cast("string")


def epoch_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as ratings with an epoch-seconds text."""
    return table(spark, d, "orders").select(
        F.col("o_totalprice").alias("rating"), epoch_text("o_orderdate").alias("ts")
    )


def rating_lines(spark: SparkSession, d: str, damaged: bool = True, sep: str = ",") -> DataFrame:
    """Order lines as text: user, movie, rating, time.

    If damaged, sixth lines of an order are cut after two fields and seventh lines hold no number.
    """
    seconds = epoch_text("l_shipdate")
    rating = F.col("l_quantity").cast("string")
    if damaged:
        rating = F.when(F.col("l_linenumber") == 6, None).otherwise(
            F.when(F.col("l_linenumber") == 7, "n/a").otherwise(rating)
        )
        seconds = F.when(F.col("l_linenumber") != 6, seconds)
    return table(spark, d, "lineitem").select(
        F.concat_ws(sep, F.col("l_orderkey"), F.col("l_partkey"), rating, seconds).alias("value")
    )


def review_lines(spark: SparkSession, d: str) -> DataFrame:
    """A header row, then all documents as semicolon-separated lines.

    Every seventh document's line has an empty id; `n_chars` modulo 4 makes up the sentiment, of
    which one is unknown.
    """
    header = spark.range(1).select(F.lit("id;review;aspect;category;sentiment").alias("value"))
    documents = table(spark, d, "documents")
    made_up = [F.lit(x) for x in ("positive", "negative", "neutral", "mixed")]
    fields = [
        F.when(F.col("doc_id") % 7 == 3, "").otherwise(F.col("doc_id").cast("string")),
        F.translate("text", "\r\n", "  "),
        F.col("source"),
        F.col("lang"),
        F.get(F.array(*made_up), (F.col("n_chars") % 4).cast("int")),
    ]
    text = [F.coalesce(f, F.lit("")) for f in fields]
    return header.unionByName(documents.select(F.concat_ws(";", *text).alias("value")))
