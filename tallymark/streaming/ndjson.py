"""Newline-delimited JSON: one object per line, as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def to_ndjson(df: DataFrame, **options) -> DataFrame:
    """One JSON object per row in a `value` column; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def parse_ndjson(lines: DataFrame, schema: str | StructType, **options) -> DataFrame:
    """Typed columns from the `value` column, batch or stream.

    A line that is not such an object lands whole in `_corrupt_record`; blank lines are skipped;
    unknown fields are ignored and missing ones are null.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    filled = lines.filter(F.col("value").rlike(r"\S"))
    return filled.select(F.from_json("value", wide, options).alias("_r")).select("_r.*")


def read_ndjson_stream(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType,
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """A stream over the files that arrive in one or more directories.

    `max_files` bounds what one batch takes of each directory.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    paths = [path] if isinstance(path, str) else list(path)
    lines = reduce(DataFrame.union, [reader.load(p) for p in paths])
    return parse_ndjson(lines, schema, **options)


def read_ndjson_socket(
    spark: SparkSession, host: str, port: int, schema: str | StructType, **options
) -> DataFrame:
    """A stream over the lines a TCP sender writes. A socket cannot replay what was lost, so
    prefer a directory."""
    lines = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return parse_ndjson(lines, schema, **options)


def ingest_ndjson(
    parsed: DataFrame, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append a parsed stream to parquet under `out`, split in `kind=good` and `kind=bad`.

    The checkpoint and the file sink's log make a restart neither lose nor repeat rows; both paths
    must be on storage that every executor sees. `once` handles what is there and stops.
    """
    kind = F.when(F.col(CORRUPT).isNull(), "good").otherwise("bad")
    marked = parsed.withColumn("kind", kind)
    writer = (
        marked.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("kind")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
