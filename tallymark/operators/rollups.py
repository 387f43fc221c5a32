"""Means over inputs that grow: sums of the files read so far are kept, and a run reads new files only."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.aggregates import merge_means, sums_by

_LISTED = "path string, modificationTime timestamp, length bigint"


def _committed(spark: SparkSession, state: str) -> DataFrame:
    """The manifest: files of all whole runs, with their run."""
    spark.createDataFrame([], _LISTED).write.mode("ignore").parquet(f"{state}/manifest/run=none")
    return spark.read.schema(f"{_LISTED}, run string").parquet(f"{state}/manifest")


def update_means(
    spark: SparkSession,
    state: str,
    paths: str | Sequence[str],
    read: Callable[[SparkSession, list[str]], DataFrame],
    keys: str | Sequence[str],
    value: str,
    scale: int | None = None,
) -> int:
    """Add the files under paths that no earlier run has read to the state; how many there were.

    `read` makes rows of a list of files; they are summed by the keys and written as (sum, count) pairs of this
    run. The manifest of its files is written last, as one file: a run that ends before it leaves
    nothing that counts, and the next one reads its files again. A file that was read and has since
    changed is refused. One run at a time.
    """
    listing = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    listing = listing.select("path", "modificationTime", "length")
    done = _committed(spark, state).drop("run")
    same = listing.alias("a").join(done.alias("b"), "path")
    differs = (F.col("a.length") != F.col("b.length")) | (F.col("a.modificationTime") != F.col("b.modificationTime"))
    if changed := same.filter(differs).select("path").head():
        raise ValueError(f"{changed.path} has changed since it was read")
    new = listing.join(done, "path", "left_anti").collect()
    if not new:
        return 0
    run = uuid.uuid4().hex
    files = [re.sub(r"([][{}*?\\])", r"\\\1", r.path) for r in sorted(new)]
    sums_by(read(spark, files), keys, value, scale).write.parquet(f"{state}/sums/run={run}")
    manifest = spark.createDataFrame(new, _LISTED).coalesce(1)
    manifest.write.parquet(f"{state}/manifest/run={run}")
    return len(new)


def read_means(spark: SparkSession, state: str, keys: str | Sequence[str], scale: int | None = None) -> DataFrame:
    """keys, `avg` and `n` over all files that whole runs have read."""
    runs = _committed(spark, state).select("run").distinct()
    sums = spark.read.parquet(f"{state}/sums").join(runs, "run", "left_semi")
    return merge_means(sums, keys, scale)
