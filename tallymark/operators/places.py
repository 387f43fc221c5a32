"""Numbering the rows of a sorted result without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import scratch_path

#: `monotonically_increasing_id` counts within a partition below this bit and partitions from it on.
_BIT = 33


def with_places(ordered: DataFrame, name: str = "place") -> DataFrame:
    """The rows of a sorted DataFrame with their number in its order, from 1.

    The sort deals rows to tasks by range. Each row is written to the scratch folder with its task and its number
    there; the rows of each task are counted, and a row's place is its number plus the rows of the
    tasks before. Only the counts, one row a task, meet in one place.
    """
    path = scratch_path(ordered.sparkSession, "places")
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    kept = ordered.sparkSession.read.schema(numbered.schema).parquet(path)
    rows = kept.withColumn("_task", F.shiftright("_at", _BIT).cast("int"))
    counts = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("_task", before.alias("_before")))
    number = F.col("_at").bitwiseAND(F.lit((1 << _BIT) - 1)) + F.col("_before") + 1
    return rows.join(starts, "_task").withColumn(name, number).select(*ordered.columns, name)
