"""Keys that very many rows share: finding them, and a join that no such key can stall.

The keys are found in one pass by a frequent-items sketch, which tasks build and Spark merges. What
is found only shapes the plan; the rows of the join are the same whatever the sketch says.
"""

from __future__ import annotations

import math
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tallymark.operators.rows import type_of

#: A hot key is cut so that a piece is about this part of an even task.
PIECE = 1 / 8
#: No key with less of the rows than this is looked for, however many tasks there are.
LEAST_SHARE = 0.001


class Frequent(NamedTuple):
    """rows: of the table; nulls: with a null key; keys: (value, about how many rows), most first."""

    rows: int
    nulls: int
    keys: list[tuple[Any, int]]


def frequent_keys(df: DataFrame, key: str, share: float = 0.01) -> Frequent:
    """The values of a column that hold `share` of its rows or more; counts are estimates.

    The sketch tracks so many values that an estimate errs by less than a quarter of `share` of the rows: each
    value with `share` or more is among them, and none with less than half of it. At most
    2 / share values come to the driver.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    kind = type_of(df, key)
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        raise ValueError(f"{key} is {kind.simpleString()}, not a plain value")
    most = math.ceil(2 / share)
    # The error is at most 3.5 of the tracked values' even share.
    tracked = min(max(1 << math.ceil(math.log2(16 / share)), 64), 100_000)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})")
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(key).alias("there"), sketch.alias("top")
    ).first()
    least = 0.75 * share * found.rows
    keys = [(x["item"], x["count"]) for x in found.top or [] if x["item"] is not None and x["count"] >= least]
    return Frequent(found.rows, found.rows - found.there, sorted(keys, key=lambda x: -x[1]))


def _pieces(key: str, frequent: Frequent, tasks: int) -> Column:
    """Into how many pieces a key's rows are cut; 1 for a key that is not hot."""
    wanted: dict[int, list] = {}
    for value, n in frequent.keys:
        # Powers of two, so that keys share a test.
        pieces = 1 << math.ceil(math.log2(max(n / frequent.rows * tasks / PIECE, 1)))
        wanted.setdefault(pieces, []).append(value)
    out = F.lit(1)
    for pieces, values in sorted(wanted.items()):
        out = F.when(F.col(key).isin(values), pieces).otherwise(out)
    return out


def _spread(df: DataFrame, over: Column) -> Column:
    """A number below `over` for each row: by its content and the task that reads it, the same on a retry."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in plain]), over)


def dealt(fact: DataFrame, key: str, frequent: Frequent, tasks: int) -> DataFrame:
    """fact with `_piece`: 0 but for hot and null keys, whose rows are dealt to pieces by their content."""
    lonely = math.ceil(max(frequent.nulls / max(frequent.rows, 1) * tasks / PIECE, 1))
    over = F.when(F.col(key).isNull(), lonely).otherwise(_pieces(key, frequent, tasks)).cast("long")
    return fact.withColumn("_piece", F.when(over > 1, _spread(fact, over)).otherwise(F.lit(0).cast("long")))


def repeated(dim: DataFrame, key: str, frequent: Frequent, tasks: int) -> DataFrame:
    """The dimension's rows that have a key, once for each `_piece` of that key."""
    every = F.sequence(F.lit(0).cast("long"), _pieces(key, frequent, tasks).cast("long") - 1)
    return dim.filter(F.col(key).isNotNull()).withColumn("_piece", F.explode(every))


def isolating_join(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "left", share: float | None = None
) -> DataFrame:
    """fact joined with dim on a column of both, `inner` or `left`, whatever share of the fact one key holds.

    One pass over the fact's keys comes first. Rows of a hot key (`share` of the fact or more, by
    default an even task's) are dealt to many tasks by their content, and the dimension's rows of
    that key repeated for each; rows with a null key, which match nothing, are dealt out likewise
    in a left join and dropped before the shuffle in an inner one. All other keys join as ever.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / tasks, LEAST_SHARE) if share is None else share
    frequent = frequent_keys(fact, key, share)
    if how == "inner":
        fact = fact.filter(F.col(key).isNotNull())
    if not frequent.keys and frequent.nulls < share * frequent.rows:
        return fact.join(dim, key, how)
    salted = dealt(fact, key, frequent, tasks)
    return salted.join(repeated(dim, key, frequent, tasks), [key, "_piece"], how).drop("_piece")

