"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.session import scratch_path

#: White space of the contracts; everything else belongs to a word.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def strings(column: pa.Array) -> list[str]:
    """Values of a text column; null is empty, broken UTF-8 is replaced."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        raw = column.cast(pa.binary()).to_pylist()
        return [(x or b"").decode("utf-8", "replace") for x in raw]


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows: what is made of their texts stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow` whose workers give unused memory back when a task ends: they live on, and the
    next stage's executors need it."""

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
            ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def prefix_sums(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Add `out`: sum of `value` over the earlier rows of the same keys (not the row itself).

    For tables of few rows a key (counts per bucket or task), not for raw rows.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order)
    total = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.coalesce(total, F.lit(0)).cast("long"))


#: Bytes of a table that may be sent to every task.
SMALL = 32 << 20


def is_small(df: DataFrame) -> bool:
    """Whether the rows of a table are counted to hold at most SMALL bytes. For tables that are written already."""
    size = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            size = size + 8 * F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(0))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= SMALL


def if_small(df: DataFrame) -> DataFrame:
    """df, hinted for broadcast if it is small; else as it is, for a join that shuffles."""
    return F.broadcast(df) if is_small(df) else df
