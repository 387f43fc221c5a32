"""Delimited text in, typed columns out. No quoting: a separator always separates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallymark.functions import split_fields, trim_blanks
from tallymark.operators.rows import pinned
from tallymark.sources.headers import csv_layouts, places_of, read_layout

POLICIES = ("drop", "fail", "keep")


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], schema: str, **options
) -> DataFrame:
    """`parse_delimited` over the lines of one or more paths or globs, read as one input."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return parse_delimited(spark.read.text(paths), schema, **options)


def parse_delimited(
    lines: DataFrame,
    schema: str,
    sep: str = ",",
    pick: Sequence[str] | None = None,
    min_fields: int | None = None,
    exact: bool = False,
    trim: bool = True,
    on_short: str = "drop",
    on_bad: str = "drop",
    empty_as_null: bool = False,
) -> DataFrame:
    """Columns of `schema` (DDL, in field order) from the `value` column of `lines`.

    `pick` keeps some columns only; fields left out are neither required nor parsed.
    `min_fields` is the least number of fields of a line (default: up to the last picked one);
    `exact` asks for just as many fields as the schema has.
    `trim` strips the line and each field and ignores empty fields at the end of the line.
    `on_short` says what becomes of a line with too few fields, `on_bad` of a field that does not
    parse: `drop` the line, `fail` the job, or `keep` the row with nulls.
    `empty_as_null` reads an empty field of a string column as null.
    """
    if on_short not in POLICIES or on_bad not in POLICIES:
        raise ValueError(f"on_short and on_bad must be one of {POLICIES}")
    rows, enough, good, names = _checked(lines, schema, sep, pick, min_fields, exact, trim)
    for condition, policy, message in (
        (enough, on_short, "wrong number of fields"),
        (good, on_bad, "unparsable field"),
    ):
        if policy == "drop":
            rows = rows.filter(condition)
        elif policy == "fail":
            raised = F.raise_error(F.lit(message)).cast("boolean")
            rows = rows.filter(F.when(condition, True).otherwise(raised))
    kinds = {f.name: f.dataType for f in StructType.fromDDL(schema).fields}
    blank = [n for n in names if empty_as_null and isinstance(kinds[n], StringType)]
    return rows.select(*[F.nullif(n, F.lit("")).alias(n) if n in blank else n for n in names])


def reject_lines(
    lines: DataFrame,
    schema: str,
    sep: str = ",",
    pick: Sequence[str] | None = None,
    min_fields: int | None = None,
    exact: bool = False,
    trim: bool = True,
) -> DataFrame:
    """The lines that `parse_delimited` with the same arguments drops, and why."""
    rows, enough, good, _ = _checked(lines, schema, sep, pick, min_fields, exact, trim)
    reason = F.when(~enough, "short").when(~good, "bad")
    lost = rows.select(F.col("_text").alias("value"), reason.alias("reason"))
    return lost.filter(F.col("reason").isNotNull())


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    header: bool = True,
    schema: str | StructType | None = None,
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, at the cost of one more
    pass over the files. A file whose header has other names, or has them in another order, fails
    the job; `read_csv_columns` reads such files.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("enforceSchema", not header)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_csv_columns(
    spark: SparkSession, path: str | Sequence[str], columns: str, sep: str = ";"
) -> DataFrame:
    """The columns of a DDL, found by their names in the header row of each file whatever their place.

    Files may order their columns differently and have others besides. They are read once for each
    different header row; only the header lines are looked at beforehand. A file that lacks a
    column, or has it twice, is refused. A value that does not parse fails the job; an empty one is null.
    """
    wanted = StructType.fromDDL(columns).fields
    layouts = csv_layouts(spark, path, sep)
    places = [places_of(layout, [f.name for f in wanted]) for layout in layouts]
    parts = []
    for layout, at in zip(layouts, places, strict=True):
        raw = read_layout(spark, layout, sep, path if len(layouts) == 1 else None)
        typed = [F.col(f"_{i}").cast(f.dataType).alias(f.name) for i, f in zip(at, wanted, strict=True)]
        parts.append(raw.select(*typed))
    if not parts:
        return spark.createDataFrame([], StructType.fromDDL(columns))
    return reduce(DataFrame.unionByName, parts)


def _checked(lines, schema, sep, pick, min_fields, exact, trim):
    """Typed rows with `_text` and `_n`, the two conditions a sound row meets, and its columns."""
    declared = StructType.fromDDL(schema).fields
    unknown = set(pick or ()) - {f.name for f in declared}
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    picked = [(i, f) for i, f in enumerate(declared) if pick is None or f.name in pick]
    lines = lines.select(F.col("value").alias("_text"))
    lines = pinned(lines, _line=trim_blanks(F.col("_text"))) if trim else lines
    line = F.col("_line" if trim else "_text")
    split = pinned(lines, _f=split_fields(line, sep, trim))
    typed = {f.name: F.get(F.col("_f"), i).try_cast(f.dataType) for i, f in picked}
    rows = pinned(split, _n=F.size("_f"), **typed)
    if exact:
        enough = F.col("_n") == len(declared)
    else:
        enough = F.col("_n") >= (min_fields or 1 + picked[-1][0])
    good = F.lit(True)
    for i, field in picked:
        if not isinstance(field.dataType, StringType):
            good = good & ((F.col("_n") <= i) | F.col(field.name).isNotNull())
    return rows, enough, good, list(typed)
