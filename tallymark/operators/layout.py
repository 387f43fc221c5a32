"""Storage layouts: tables that join without a shuffle, and files that a range filter can leave out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from tallymark.operators.rows import type_of
from tallymark.operators.skew import LEAST_SHARE, dealt, frequent_keys, repeated

#: Each clustered column is cut into 2^LEVELS parts of about equal rows.
LEVELS = 6


def write_colocated(
    fact: DataFrame, dims: Mapping[str, DataFrame], key: str, name: str, folder: str, buckets: int = 64
) -> None:
    """Write a fact table and its dimensions as tables `<name>_fact`, `<name>_<dim>` in buckets of a key.

    A key with an even bucket's share of the fact's rows or more is spread over sub-buckets, and
    its dimension rows are repeated in each; rows with a null key are spread too. So no bucket is
    much larger than the others, and `colocated_join` needs no shuffle. Files go to `folder`; existing tables
    of these names are replaced.
    """
    if "fact" in dims:
        raise ValueError("a dimension cannot be called fact")
    frequent = frequent_keys(fact, key, max(1 / buckets, LEAST_SHARE))
    frames = {"fact": dealt(fact, key, frequent, buckets)}
    frames |= {dim: repeated(df, key, frequent, buckets) for dim, df in dims.items()}
    for part, df in frames.items():
        # Dealt as the table is bucketed: one file for each bucket.
        by_bucket = df.repartition(buckets, key, "_piece").write.bucketBy(buckets, key, "_piece")
        by_bucket.sortBy(key, "_piece").mode("overwrite").option("path", f"{folder}/{part}").saveAsTable(f"{name}_{part}")


def colocated_join(
    spark: SparkSession, name: str, dim: str, key: str, how: str = "inner", where: Column | None = None
) -> DataFrame:
    """The fact table joined with a dimension that was written with it, `inner` or `left`; each bucket by itself.

    `where` filters the dimension first.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    side = spark.table(f"{name}_{dim}")
    side = side if where is None else side.filter(where)
    return spark.table(f"{name}_fact").join(side, [key, "_piece"], how).drop("_piece")


def _measure(df: DataFrame, col: str) -> Column:
    """A column as a number that orders it."""
    kind = type_of(df, col)
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(kind, NumericType):
        return F.col(col).cast("double")
    raise ValueError(f"{col} is {kind.simpleString()}: only numbers, dates and timestamps can be clustered")


def _part(measure: Column, bounds: Sequence[float]) -> Column:
    """How many of the bounds a measure reaches; none if it is null."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(b) for b in sorted(set(bounds))])
    return F.size(F.filter(steps, lambda bound: bound <= measure))


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int = 64) -> None:
    """Write parquet files in which rows near each other in all of `cols` lie together.

    Each column is cut at its quantiles and the part numbers are interleaved bit by bit (a
    Z-curve); the files are ranges of that curve. Null counts as least. The least and greatest value of each
    column in each file are kept beside the files, for `read_clustered`.
    """
    parts = (1 << LEVELS) - 1
    cuts = [F.approx_percentile(_measure(df, c), [i / (parts + 1) for i in range(1, parts + 1)]) for c in cols]
    bounds = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(cuts)]).first()
    curve = F.lit(0).cast("long")
    for i, col in enumerate(cols):
        part = _part(_measure(df, col), bounds[i] or [])
        for bit in range(LEVELS):
            # Bit b of column i is bit b * columns + i of the curve.
            one = F.shiftright(part, bit).bitwiseAND(F.lit(1)).cast("long")
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(cols) + i))
    laid = df.withColumn("_curve", curve).repartitionByRange(files, "_curve", *cols)
    laid.sortWithinPartitions("_curve", *cols).drop("_curve").write.parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    ends = [f(c).alias(f"{n} {c}") for c in cols for n, f in (("least", F.min), ("most", F.max))]
    written.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends).write.parquet(f"{path}/ends")


def read_clustered(spark: SparkSession, path: str, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The rows with low <= column < high for each {column: (low, high)}; None leaves an end open.

    Only files whose least and greatest values allow such rows are opened.
    """
    ends, keep = spark.read.parquet(f"{path}/ends"), F.lit(True)
    rows = F.lit(True)
    for col, (low, high) in ranges.items():
        if low is not None:
            keep, rows = keep & (F.col(f"`most {col}`") >= low), rows & (F.col(col) >= low)
        if high is not None:
            keep, rows = keep & (F.col(f"`least {col}`") < high), rows & (F.col(col) < high)
    files = [r.file for r in ends.filter(keep).select("file").collect()]
    whole = spark.read.parquet(f"{path}/data")
    if not files:
        return spark.createDataFrame([], whole.schema)
    return spark.read.schema(whole.schema).parquet(*files).filter(rows)
