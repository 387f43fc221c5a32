"""Exact distinct counts by bitmaps: 64 neighbouring numbers travel as one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, IntegerType, LongType, ShortType

from tallymark.operators.rows import type_of
from tallymark.session import scratch_path

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def mappable(kind: DataType) -> bool:
    """Whether values of a type have a number of their own that a bitmap can hold."""
    return isinstance(kind, (*_WHOLE, DateType))


def _number(df: DataFrame, col: str) -> Column:
    return F.unix_date(col).cast("long") if isinstance(type_of(df, col), DateType) else F.col(col).cast("long")


def bit_of(number: Column) -> Column:
    """The word in which only the bit of a number among its 64 is set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def slot_and_bit(df: DataFrame, col: str) -> tuple[Column, Column]:
    """Of a whole number or date: which 64 numbers it is among, and its bit there; null for null."""
    number = _number(df, col)
    return F.shiftright(number, 6), bit_of(number)


def distinct_by(df: DataFrame, keys: Sequence[str], col: str, name: str, **sums: Column) -> DataFrame:
    """keys, `name`: the exact number of distinct values of a whole-number or date column, nulls not
    counted, and the given sums.

    Tasks set bits for each group and 64 numbers; the words are or-ed together and their bits
    counted. A row is shuffled for each group and word, at most as many as for group and value, and up to
    64 times fewer the closer the values lie (see `numbered_values`).
    """
    slot, bit = slot_and_bit(df, col)
    parts = [total.alias(f"_sum {n}") for n, total in sums.items()]
    words = df.groupBy(*keys, slot.alias("_slot")).agg(F.bit_or(bit).alias("_bits"), *parts)
    count = F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias(name)
    return words.groupBy(*keys).agg(count, *[F.sum(f"_sum {n}").alias(n) for n in sums])


def distinct_each(df: DataFrame, cols: dict[str, str], count_null: bool, rows: str | None) -> DataFrame:
    """One row with a column for each {metric: column} of whole numbers or dates, in one scan; see `distinct_totals`."""
    entries = []
    for metric, col in cols.items():
        slot, bit = slot_and_bit(df, col)
        entries.append(F.struct(F.lit(metric).alias("metric"), slot.alias("slot"), bit.alias("bit")))
    # All columns side by side, combined within the task that reads them.
    words = df.select(F.inline(F.array(*entries))).groupBy("metric", "slot")
    words = words.agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
    found = {}
    if rows is not None:
        mine = F.col("metric") == next(iter(cols))
        found[rows] = F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))
    for metric in cols:
        mine = F.col("metric") == metric
        null = F.coalesce(F.max(F.when(mine, F.col("slot").isNull().cast("bigint"))), F.lit(0))
        found[metric] = F.coalesce(F.sum(F.when(mine, F.bit_count("bits"))), F.lit(0)) + (null if count_null else 0)
    return words.agg(*[total.cast("bigint").alias(metric) for metric, total in found.items()])


def numbered_values(df: DataFrame, col: str, name: str) -> DataFrame:
    """df with `name`: a whole number for each value of a column, null for null; close together.

    A dictionary step for text keys: the distinct values are written to the scratch folder with a
    number each, counted up within each of its files, and joined back; Spark broadcasts the dictionary if it is small.
    """
    path = scratch_path(df.sparkSession, "dictionary")
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    numbers = values.select(col, F.monotonically_increasing_id().alias(name))
    numbers.write.parquet(path)
    return df.join(df.sparkSession.read.schema(numbers.schema).parquet(path), col, "left").select(*df.columns, name)
