"""Top rows, over everything and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import scratch_path

#: Values that the sketch of a group tracks. An estimate errs by at most 3.5 / TRACKED of the group's rows.
TRACKED = 1 << 16
_MARGIN = 3.5 / TRACKED


def _order(by: str, ties: Sequence[str]):
    return [F.desc(by), *[F.asc(t) for t in ties]]


def top_n(df: DataFrame, n: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The n rows with the greatest `by`; `ties` name the columns that settle equal values."""
    return df.orderBy(*_order(by, ties)).limit(n)


def top_n_per_group(
    df: DataFrame, group: str | Sequence[str], n: int, by: str, ties: Sequence[str]
) -> DataFrame:
    """The n rows with the greatest `by` of each group.

    The rank filter lets Spark cut each task's rows to n per group before the shuffle, so a hot
    group sends n rows per task.
    """
    groups = [group] if isinstance(group, str) else list(group)
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*_order(by, ties)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def most_frequent(
    df: DataFrame, group: str | Sequence[str], value: str, n: int, name: str = "frequency"
) -> DataFrame:
    """The n commonest values of each group with their exact number of rows, ties by value; null is no value.

    A first pass keeps a frequent-items sketch for each group, a bounded number of values for each task.
    Where the n-th best estimate, less the greatest error, is above all that an untracked or
    smaller value can have, only the values that may be among the n are counted in the second
    pass, exactly and with equal ones; a group whose values are too even for such a cut is counted whole. So the rows
    are those of counting everything, but the tail of the values is not shuffled. Groups are few:
    each holds a sketch. `group` may be an empty list.
    """
    groups = [group] if isinstance(group, str) else list(group)
    asked = min(max(64, 16 * n), TRACKED)
    there = df.filter(F.col(value).isNotNull())
    sketch = F.expr(f"approx_top_k(`{value}`, {asked}, {TRACKED})").alias("_top")
    found = there.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"), sketch)
    counts = F.sort_array(F.transform("_top", lambda x: x["count"]), asc=False)
    error = F.col("_rows") * _MARGIN
    # What is not listed: untracked or too unsure (twice the error), or not above the last of a full list.
    full = F.when(F.size("_top") >= asked, F.get(counts, F.lit(asked - 1)) + error)
    unlisted = F.greatest(2 * error, F.coalesce(full, F.lit(0.0)))
    least = F.get(counts, F.lit(n - 1)) - error  # n values have as many rows
    sound = F.coalesce(least > unlisted, F.lit(False))
    picked = F.transform(F.filter("_top", lambda x: x["count"] + error >= least), lambda x: x["item"])
    cuts = found.select(*groups, F.when(sound, picked).alias("_picked"))
    if not groups:
        few = cuts.first()._picked  # at most `asked` values
        kept = there if few is None else there.filter(F.col(value).isin(few))
        return top_n(kept.groupBy(value).agg(F.count(F.lit(1)).alias(name)), n, name, [value])
    path = scratch_path(df.sparkSession, "frequent")
    cuts.write.parquet(path)
    cuts = df.sparkSession.read.schema(cuts.schema).parquet(path).toDF(*[f"_g{i}" for i in range(len(groups))], "_picked")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    kept = there.join(cuts, same).filter(F.col("_picked").isNull() | F.array_contains("_picked", F.col(value)))
    totals = kept.groupBy(*groups, value).agg(F.count(F.lit(1)).alias(name))
    return top_n_per_group(totals, groups, n, name, [value])
