from tallymark.sources.delimited import (
    parse_delimited,
    read_csv,
    read_csv_columns,
    read_delimited,
    reject_lines,
)
from tallymark.sources.headers import Layout, csv_layouts
from tallymark.sources.sinks import delimited_lines, write_delimited, write_text

__all__ = [
    "Layout",
    "csv_layouts",
    "delimited_lines",
    "parse_delimited",
    "read_csv",
    "read_csv_columns",
    "read_delimited",
    "reject_lines",
    "write_delimited",
    "write_text",
]
