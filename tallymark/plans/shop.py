"""Shop queries over orders, order items, reviews, products and customers.

Column names are those of the shop's files; Spark resolves them without regard to case.
`SCHEMAS` declares the files, with money as DECIMAL so that sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import (
    avg_count_by,
    count_by,
    distinct_totals,
    in_year,
    lookup,
    pair_stats,
    revenue_by,
    revenue_by_lookup,
    valid_scores,
)

# The columns of the shop's files that the queries use, and their types.
SCHEMAS = {
    "customers": "Customer_Trx_ID string, Customer_Country string",
    "orders": "Order_ID string, Customer_Trx_ID string, Order_Purchase_Timestamp timestamp",
    "items": "Order_ID string, Product_ID string, Seller_ID string, Price decimal(28,10), "
    "Freight_Value decimal(28,10)",
    "reviews": "Order_ID string, Review_Score string",
    "products": "Product_ID string, Product_Category_Name string",
}


def totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Number of order rows, of distinct customers and of distinct sellers, one row each."""
    ordered = distinct_totals(orders, {"total_customers": "customer_trx_id"}, rows="total_orders")
    return ordered.unionByName(distinct_totals(items, {"total_sellers": "seller_id"}))


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per customer country, most first.

    Orders are counted per customer before the join, so one busy customer is one row in it.
    """
    per_customer = orders.groupBy("customer_trx_id").agg(F.count(F.lit(1)).alias("_n"))
    located = per_customer.join(
        customers.select("customer_trx_id", "customer_country"), "customer_trx_id"
    )
    counts = located.groupBy("customer_country").agg(F.sum("_n").alias("n"))
    return counts.orderBy(F.desc("n"), "customer_country")


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per month: years up, months down."""
    moment = F.col("order_purchase_timestamp")
    dated = orders.select(
        F.year(moment).alias("order_year"), F.month(moment).alias("order_month")
    )
    counts = dated.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.asc("order_year"), F.desc("order_month"))


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score 1 to 5; other scores are left out."""
    return count_by(valid_scores(reviews, "review_score"), "score", "score").orderBy("score")


def score_summary(reviews: DataFrame) -> DataFrame:
    """Reviews and mean per score 1 to 5, and over all of them with a null score; one scan."""
    counts = count_by(valid_scores(reviews, "review_score"), "score", "score")
    summed = counts.rollup("score").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("avg")
    )
    return summed.filter("n > 0")


def average_score(reviews: DataFrame) -> DataFrame:
    """Mean of the scores 1 to 5, one row."""
    return avg_count_by(valid_scores(reviews, "review_score"), [], "score")


def category_revenue(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    year: int,
    salts: int = 1,
    isolate: bool = False,
) -> DataFrame:
    """Price plus freight per product category over the orders of one year, most first.

    `salts` and `isolate` are for orders with very many items, see `lookup`.
    """
    ordered = in_year(orders, "order_purchase_timestamp", year).select("order_id")
    sold = items.select("order_id", "product_id", "price", "freight_value")
    revenue = revenue_by_lookup(
        lookup(sold, ordered, "order_id", [], "inner", salts=salts, isolate=isolate),
        products,
        "product_id",
        "product_category_name",
        "price",
        "freight_value",
    )
    return revenue.orderBy(F.desc("total_revenue"), "product_category_name")


def product_stats(items: DataFrame, reviews: DataFrame, salts: int = 1) -> DataFrame:
    """Item-review pairs of the same order per product, and their mean score; most pairs first."""
    stats = pair_stats(items, reviews, "order_id", "product_id", "review_score", salts)
    return stats.orderBy(F.desc("total_sold"), "product_id")


def seller_stats(items: DataFrame, dictionary: bool = False) -> DataFrame:
    """Revenue and distinct orders per seller, most first; `dictionary` numbers orders first, see `revenue_by`."""
    stats = revenue_by(items, ["seller_id"], "price", "freight_value", "order_id", dictionary)
    return stats.orderBy(F.desc("total_revenue"), F.desc("total_orders"), "seller_id")
