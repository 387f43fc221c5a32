"""Two uses of a generator that yields one row: the optimizer does not look through it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def pinned(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a plain computed column is moved below it with the whole expression repeated in
    it, and again for every use; parsing text or JSON is worth doing once.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def type_of(df: DataFrame, col: str) -> DataType:
    """The type of a column, found as Spark finds it: without regard to case unless it is told to."""
    return df.select(F.col(f"`{col}`")).schema[0].dataType


def fresh_rows(df: DataFrame) -> DataFrame:
    """The same rows with their partitioning forgotten.

    The adaptive skew split needs both sides of a join freshly shuffled, but Spark skips the
    shuffle of a side just grouped by the join key. Use this on such a side, one row per key, when
    the other side may hold a hot key.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
