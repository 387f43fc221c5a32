"""Leaving out the rows whose value is in a large table, without shuffling the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.distinct import bit_of
from tallymark.operators.rows import fresh_rows
from tallymark.session import scratch_path

#: Bits of the largest filter: a slot of 64 bits is a row, so at most 2^19 rows are broadcast.
MOST_BITS = 1 << 25
#: Bits for each value, while that is below MOST_BITS.
BITS_EACH = 16
#: Values kept beside the filter are broadcast up to this many bytes, counted before.
MOST_BYTES = 32 << 20


def _slot(value: Column, bits: int) -> tuple[Column, Column]:
    """Slot and bit of a value."""
    at = F.pmod(F.xxhash64(value), F.lit(bits))
    return F.shiftright(at, 6), bit_of(at)


def membership_filter(values: DataFrame, col: str, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(slot, bits) of the hashed values of a column, and the number of bits of the whole filter.

    Each task sets its bits, and the maps are or-ed together. The filter has no more than most_bits / 64 rows,
    whatever the table; a value of the table always finds its bit set. Nulls set none.
    """
    there = values.filter(F.col(col).isNotNull())
    n = there.agg(F.approx_count_distinct(col, 0.02)).first()[0]
    bits = min(1 << max(10, math.ceil(math.log2(max(n, 1) * BITS_EACH))), most_bits)
    slot, bit = _slot(F.col(col), bits)
    return there.groupBy(slot.alias("_slot")).agg(F.bit_or(bit).alias("_bits")), bits


def drop_members(rows: DataFrame, values: DataFrame, col: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose `col` is not among the first column of `values`, in two passes over the rows.

    A hashed filter of bounded size is broadcast; rows whose value it rules out stay at once. Of
    the others only the distinct values are shuffled, to an exact anti-join: the few that are not
    in the table after all (the filter's false hits) are written to the scratch folder. If they
    are counted to be small they are broadcast and no row is shuffled; else the rows in doubt, and
    only those, are semi-joined with them. Null values stay.
    """
    table = values.select(F.col(values.columns[0]).alias(col))
    filter_, bits = membership_filter(table, col, most_bits)
    path = scratch_path(rows.sparkSession, "membership")
    filter_.write.parquet(f"{path}/filter")
    bounded = F.broadcast(rows.sparkSession.read.schema(filter_.schema).parquet(f"{path}/filter"))
    slot, bit = _slot(F.col(col), bits)
    marked = rows.withColumn("_slot", slot).join(bounded, "_slot", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)) & F.col(col).isNotNull()
    marked = marked.withColumn("_hit", hit)

    doubted = marked.filter("_hit").select(col).distinct()
    false_hits = doubted.join(fresh_rows(table.distinct()), col, "left_anti")
    false_hits.write.parquet(f"{path}/false-hits")
    spared = rows.sparkSession.read.schema(false_hits.schema).parquet(f"{path}/false-hits")
    n, size = spared.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(col).cast("string")))).first()
    if 32 * n + (size or 0) <= MOST_BYTES:
        spared = F.broadcast(spared.withColumn("_spared", F.lit(True)))
        judged = marked.join(spared, col, "left")
        return judged.filter(~F.col("_hit") | F.col("_spared").isNotNull()).select(*rows.columns)
    ruled_out = marked.filter(~F.col("_hit")).select(*rows.columns)
    return ruled_out.unionByName(marked.filter("_hit").select(*rows.columns).join(spared, col, "left_semi"))
