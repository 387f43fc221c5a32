"""Counts, means and the pivots built on them.

Every mean goes through a mergeable (sum, count) pair, so that a hot key shrinks to one row per
task before the shuffle. `scale=2` sums exact hundredths; no scale sums the values as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import mean, split_fields, summable, trim_blanks
from tallymark.operators.distinct import distinct_each, mappable
from tallymark.operators.joins import one_per_key
from tallymark.operators.rows import type_of
from tallymark.operators.topk import top_n


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sums_by(
    df: DataFrame, keys: str | Sequence[str], value: str, scale: int | None = None
) -> DataFrame:
    """keys, `_sum` and `_n`: the pair that later merges into a mean."""
    amount = summable(F.col(value), scale)
    return df.groupBy(*_keys(keys)).agg(F.sum(amount).alias("_sum"), F.count(value).alias("_n"))


def merge_means(
    sums: DataFrame, keys: str | Sequence[str], scale: int | None = None
) -> DataFrame:
    """keys, `avg` and `n` from rows of (sum, count) pairs."""
    keys = _keys(keys)
    merged = sums.groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("n"))
    return merged.select(*keys, mean(F.col("_sum"), F.col("n"), scale).alias("avg"), "n")


def avg_count_by(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    scale: int | None = None,
    support: int | None = None,
) -> DataFrame:
    """keys, `avg` and `n`; with `support`, only the groups of at least that many values."""
    keys = _keys(keys)
    pairs = sums_by(df, keys, value, scale)
    out = pairs.select(
        *keys, mean(F.col("_sum"), F.col("_n"), scale).alias("avg"), F.col("_n").alias("n")
    )
    return out if support is None else out.filter(F.col("n") >= support)


def best_with_min_support(
    df: DataFrame, key: str, value: str, support: int = 5, scale: int | None = None
) -> DataFrame:
    """The key of the highest mean among those with enough values; the smaller key wins a tie."""
    return top_n(avg_count_by(df, key, value, scale, support), 1, "avg", [key])


def avg_by_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attrs: str | Sequence[str],
    value: str,
    scale: int | None = None,
) -> DataFrame:
    """Mean and count per attribute of the joined dimension row.

    The fact is summed by the join key first: the join sees each key once, however hot it is.
    """
    attrs = _keys(attrs)
    joined = sums_by(fact, key, value, scale).join(dim.select(key, *attrs), key)
    return merge_means(joined, attrs, scale)


def avg_by_multivalue(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attr: str,
    value: str,
    sep: str = "|",
    scale: int | None = None,
) -> DataFrame:
    """Mean and count per element of a delimited attribute, such as a genre list.

    A repeated element or dimension row counts each time. The fact is summed by key before the
    elements multiply it.
    """
    parts = split_fields(trim_blanks(F.col(attr)), sep)
    elements = dim.select(key, F.explode(parts).alias(attr))
    return merge_means(sums_by(fact, key, value, scale).join(elements, key), attr, scale)


def _labelled_means(
    df: DataFrame,
    keys: str | Sequence[str],
    is_label: dict[str, Column],
    value: str,
    scale: int | None,
) -> DataFrame:
    keys = _keys(keys)
    amount = summable(F.col(value), scale)
    pairs = []
    for name, hit in is_label.items():
        pairs.append(F.sum(F.when(hit, amount)).alias(f"_sum {name}"))
        pairs.append(F.count(F.when(hit, F.col(value))).alias(f"_n {name}"))
    means = [
        mean(F.col(f"`_sum {name}`"), F.col(f"`_n {name}`"), scale).alias(name)
        for name in is_label
    ]
    return df.groupBy(*keys).agg(*pairs).select(*keys, *means)


def conditional_avg(
    df: DataFrame,
    keys: str | Sequence[str],
    group: str,
    labels: dict[str, str],
    value: str,
    scale: int | None = None,
) -> DataFrame:
    """One mean column per label (`{column: label}`), matched without regard to case.

    Rows with another label count nowhere, and a key with none of the labels is left out.
    """
    upper = F.upper(F.col(group))
    wanted = {name: upper == label.upper() for name, label in labels.items()}
    known = df.filter(upper.isin([label.upper() for label in labels.values()]))
    return _labelled_means(known, keys, wanted, value, scale)


def bucketed_avg_wide(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    bucket: str,
    labels: Sequence[str],
    value: str,
    scale: int | None = None,
    many: bool = False,
) -> DataFrame:
    """Every dimension row with one mean column per bucket label; empty buckets are null.

    Rows without a bucket and rows of keys the dimension lacks are left out. `many` is for a
    dimension where very many rows share a key or have none, see `one_per_key`.
    """
    wanted = {label: F.col(bucket) == label for label in labels}
    known = fact.filter(F.col(bucket).isin(list(labels)))
    means = _labelled_means(known, key, wanted, value, scale)
    return one_per_key(dim, key, many).join(means, key, "left")


def count_by(df: DataFrame, keys: str | Sequence[str], id_col: str, name: str = "n") -> DataFrame:
    """Rows per group whose id is not null."""
    return df.groupBy(*_keys(keys)).agg(F.count(id_col).alias(name))


def distinct_totals(
    df: DataFrame, cols: dict[str, str], count_null: bool = True, rows: str | None = None
) -> DataFrame:
    """One row (`metric`, `total`) per entry of `{metric: column}`: its distinct values.

    `count_null=True` counts null as one value. `rows` names a first metric: the number of rows.
    One scan, however many metrics. Whole numbers and dates are counted by bitmaps, other types by
    shuffling their distinct values.
    """
    found = [rows, *cols] if rows is not None else list(cols)
    if all(mappable(type_of(df, col)) for col in cols.values()):
        one = distinct_each(df, cols, count_null, rows)
    else:
        totals = [F.count(F.lit(1)).alias(rows)] if rows is not None else []
        for metric, col in cols.items():
            null = F.coalesce(F.max(F.col(col).isNull().cast("bigint")), F.lit(0))
            totals.append((F.countDistinct(col) + (null if count_null else 0)).alias(metric))
        one = df.agg(*totals)
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("bigint").alias("total"))
        for m in found
    ]
    return one.select(F.inline(F.array(*pairs)))
