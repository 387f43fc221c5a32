"""Order, revenue and review rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallymark.functions import mean, year_range
from tallymark.operators.distinct import distinct_by, mappable, numbered_values
from tallymark.operators.joins import lookup
from tallymark.operators.rows import fresh_rows, type_of


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows whose timestamp or date column lies in the year; a column of another type is refused."""
    dtype = df.select(ts).schema[0].dataType
    if not isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"{ts} is {dtype.simpleString()}, not a date or timestamp")
    return df.filter(year_range(F.col(ts), dtype, year))


def valid_scores(
    df: DataFrame, score: str, low: int = 1, high: int = 5, name: str = "score"
) -> DataFrame:
    """Rows whose score reads as a whole number from `low` to `high`, with that number added."""
    return df.withColumn(name, F.col(score).try_cast("int")).filter(
        F.col(name).between(low, high)
    )


def revenue_by(
    df: DataFrame,
    keys: Sequence[str],
    price: str,
    freight: str,
    distinct: str | None = None,
    dictionary: bool = False,
) -> DataFrame:
    """Price plus freight per group as `total_revenue`, summed as they are, rounded to cents at last.

    DECIMAL columns are summed exactly, in any row order. With `distinct`, also the number of
    distinct values of that column as `total_orders`: whole numbers and dates by bitmaps, other types by
    shuffling each value of each group or, with `dictionary`, by the bitmaps of numbers written for them.
    """
    revenue = F.sum(F.col(price) + F.col(freight))
    if distinct is not None and (dictionary or mappable(type_of(df, distinct))):
        if dictionary:
            df, distinct = numbered_values(df, distinct, "_number"), "_number"
        found = distinct_by(df, keys, distinct, "total_orders", _revenue=revenue)
        total = F.round("_revenue", 2).cast("double").alias("total_revenue")
        return found.select(*keys, total, "total_orders")
    aggs = [F.round(revenue, 2).cast("double").alias("total_revenue")]
    if distinct is not None:
        aggs.append(F.countDistinct(distinct).alias("total_orders"))
    return df.groupBy(*keys).agg(*aggs)


def revenue_by_lookup(
    items: DataFrame,
    dim: DataFrame,
    key: str,
    attr: str,
    price: str,
    freight: str,
) -> DataFrame:
    """Price plus freight per attribute of the joined dimension row, as `total_revenue`.

    Summed as in `revenue_by`.

    Items are summed by the join key first: the join sees each key once, however hot it is.
    """
    revenue = F.sum(F.col(price) + F.col(freight)).alias("_sum")
    joined = items.groupBy(key).agg(revenue).join(dim.select(key, attr), key)
    total = F.round(F.sum("_sum"), 2).cast("double")
    return joined.groupBy(attr).agg(total.alias("total_revenue"))


def pair_stats(
    items: DataFrame, reviews: DataFrame, key: str, group: str, score: str, salts: int = 1
) -> DataFrame:
    """Per group: the number of item-review pairs that share a key, and their mean score.

    Items are counted per key and group, reviews per key, and the counts multiplied: no pair is
    built, and copies shrink to one row before the shuffle.
    Scores that are not whole numbers count as pairs but not in the mean.
    """
    whole = F.col(score).try_cast("int")
    per_key = reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("_reviews"),
        F.sum(whole.cast("bigint")).alias("_score"),
        F.count(whole).alias("_scored"),
    )
    per_item = items.groupBy(key, group).agg(F.count(F.lit(1)).alias("_items"))
    counts = ["_reviews", "_score", "_scored"]
    met = lookup(per_item, fresh_rows(per_key), key, counts, "inner", salts=salts)
    n_pairs = F.when(F.col(group).isNotNull(), F.col("_items") * F.col("_reviews")).otherwise(0)
    sums = met.groupBy(group).agg(
        F.sum(n_pairs).alias("total_sold"),
        F.sum(F.col("_items") * F.col("_score")).alias("_score"),
        F.sum(F.col("_items") * F.col("_scored")).alias("_scored"),
    )
    average = mean(F.col("_score"), F.col("_scored"), None)
    return sums.select(group, "total_sold", F.round(average, 2).alias("average_score"))
