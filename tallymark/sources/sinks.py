"""Text sinks: one line per row, fields joined as they are, null as an empty field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delimited_lines(df: DataFrame, sep: str = ";") -> DataFrame:
    """One `value` column with the row's fields joined by the separator."""
    fields: list[Column] = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns
    ]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "error") -> None:
    delimited_lines(df, sep).write.mode(mode).text(path)


def write_text(df: DataFrame, path: str, mode: str = "error") -> None:
    """Key, tab, value."""
    write_delimited(df, path, "\t", mode)
