"""Joins of a fact table with its dimensions.

No join here is hinted: Catalyst broadcasts a side only when its known size is under
`spark.sql.autoBroadcastJoinThreshold`, and otherwise sort-merges with the adaptive skew split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.rows import fresh_rows
from tallymark.operators.skew import isolating_join


def one_per_key(dim: DataFrame, key: str, many: bool = False) -> DataFrame:
    """One row per key: the greatest of the rows that share it, so the choice is repeatable.

    One shuffle and one sort by the key, both of which a join by the key uses again. `many=True`
    is for keys that very many rows share: they are cut to one row per task before the shuffle,
    for one more sort.
    """
    rest = [c for c in dim.columns if c != key]
    if not rest:
        return dim.distinct()
    if many:
        picked = dim.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row"))
        return picked.select(key, *[F.col("_row")[c].alias(c) for c in rest])
    # A row with none before it; a row number would be cut early, after a sort before the shuffle.
    greatest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in rest])
    earlier = F.lag(F.lit(True)).over(greatest_first)
    return dim.withColumn("_earlier", earlier).filter("_earlier is null").drop("_earlier")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    cols: Sequence[str],
    how: str = "left",
    unique: bool = False,
    salts: int = 1,
    hot: bool = False,
    isolate: bool = False,
) -> DataFrame:
    """Add `cols` of the dimension to the fact rows.

    `unique=True` keeps one dimension row per key first, so no fact row is multiplied. The join
    then uses that shuffle again, and so cannot split a hot key; `hot=True` shuffles the picked
    rows once more so that it can.
    A hot key of the fact is left to the adaptive skew split, which goes by compressed bytes and
    may miss a key whose rows are copies of each other. `salts` splits every key over that many
    tasks instead, and repeats the dimension as often; it takes effect when the join shuffles.
    `isolate=True` finds the hot keys first, in a pass of its own, and splits only those and the
    null keys, see `isolating_join`; and it is safe for a dimension key that very many rows share.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    side = dim.select(key, *cols)
    if unique:
        side = one_per_key(side, key, many=isolate)
        side = fresh_rows(side) if hot else side
    if isolate:
        return isolating_join(fact, side, key, how)
    if salts == 1:
        return fact.join(side, key, how)
    # The number of the task that reads a row: the same on a retry, whatever the row order.
    salted = fact.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    joined = salted.join(side.withColumn("_salt", every), [key, "_salt"], how)
    return joined.drop("_salt")


def attach_title(
    fact_agg: DataFrame,
    dim: DataFrame,
    key: str,
    title: str,
    how: str = "left",
    default: str = "Unknown",
    few: bool = False,
    many: bool = False,
) -> DataFrame:
    """Put the title on rows already aggregated by `key`, so that no key is hot.

    `left` keeps every key, takes one title per key and fills in `default`;
    `inner` drops keys without a title and repeats a key that has several.
    `few=True` is for a handful of keys: one title per key is picked after the join. `many=True` is
    for titles of which very many share a key or have none, see `one_per_key`.
    """
    if how == "inner":
        return lookup(fact_agg, dim, key, [title], "inner")
    titles = dim.select(key, title)
    if few:
        titled = one_per_key(fact_agg.join(titles, key, "left"), key)
    else:
        titled = fact_agg.join(one_per_key(titles, key, many), key, "left")
    return titled.withColumn(title, F.coalesce(F.col(title), F.lit(default)))
