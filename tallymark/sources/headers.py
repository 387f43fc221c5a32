"""Header rows of CSV files, read file by file, and the layouts they form."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Files whose header is being read at a time.
READERS = 16


class Layout(NamedTuple):
    """Files with one and the same header row; `plain` if Spark can check the row against the names."""

    names: tuple[str, ...]
    files: list[str]
    plain: bool


def _first_line(spark: SparkSession, uri: str) -> str | None:
    """The first line of a file that is not blank, unpacked if its name says so; None without one."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        bare = stream if codec is None else codec.createInputStream(stream)
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(bare, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def csv_layouts(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> list[Layout]:
    """The different header rows of the files under one or more paths or globs, and whose they are.

    Opens each file once and reads its first line, no data; files without a line are left out.
    """
    files = spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda uri: _first_line(spark, uri), files))
    found: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for uri, line in zip(files, lines, strict=True):
        if line is not None:
            names = tuple(next(csv.reader([line.removeprefix("﻿")], delimiter=sep)))
            plain = not line.startswith("﻿") and len({n.lower() for n in names}) == len(names)
            found.setdefault((names, plain), []).append(uri)
    return [Layout(names, uris, plain) for (names, plain), uris in found.items()]


def places_of(layout: Layout, wanted: Sequence[str]) -> list[int]:
    """Where the wanted columns stand, found without regard to case."""
    there = [n.lower() for n in layout.names]
    missing = [n for n in wanted if n.lower() not in there]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {list(layout.names)} of {layout.files[0]}")
    twice = [n for n in wanted if there.count(n.lower()) > 1]
    if twice:
        raise ValueError(f"columns {twice} are more than once in the header of {layout.files[0]}")
    return [there.index(n.lower()) for n in wanted]


def read_layout(spark: SparkSession, layout: Layout, sep: str, path: str | Sequence[str] | None) -> DataFrame:
    """All rows of a layout's files as text, in columns `_0`, `_1`, ...; `path` if it holds just these files.

    Spark checks the header of each file again when it reads it, wherever the names allow that.
    """
    names = layout.names if layout.plain else [f"_{i}" for i in range(len(layout.names))]
    schema = StructType([StructField(n, StringType()) for n in names])
    reader = spark.read.schema(schema).option("sep", sep).option("header", True)
    reader = reader.option("enforceSchema", not layout.plain)
    uri, glob = spark._jvm.java.net.URI, str.maketrans({c: f"\\{c}" for c in "\\{}[]*?"})
    paths = path
    if paths is None:
        paths = [spark._jvm.org.apache.hadoop.fs.Path(uri(f)).toString().translate(glob) for f in layout.files]
    read = reader.csv(paths if isinstance(paths, str) else list(paths))
    # Folders named like `day=1` add columns of their own at the end.
    return read.select(*[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(names)])
