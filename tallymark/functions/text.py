"""Text helpers shared by ingest, tokenizing and report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blank and all control characters below it, and the regex metacharacters.
BLANKS = "".join(chr(c) for c in range(0x21))
REGEX_META = r".$|()[{^?*+\\"


def trim_blanks(value: Column) -> Column:
    """Strip blanks, tabs and other control characters from both ends."""
    touched = (value < F.lit("!")) | (F.substring(value, -1, 1) < F.lit("!"))
    return F.when(touched, F.btrim(value, F.lit(BLANKS))).otherwise(value)


def separator_regex(sep: str) -> str:
    """A pattern that matches the one-character separator literally."""
    if len(sep) != 1:
        raise ValueError("the separator must be one character")
    return f"\\{sep}" if sep in REGEX_META else sep


def split_fields(value: Column, sep: str, trim: bool = True) -> Column:
    """Array of the fields between separators.

    `trim` strips the blanks around each field of a line that has none at its ends, and ignores
    empty fields at the end, so that text of separators alone has no field at all. Empty text is
    one empty field either way.
    """
    pattern = separator_regex(sep)
    if not trim:
        return F.split(value, pattern)
    fields = F.split(value, f"[\\x00-\\x20]*{pattern}[\\x00-\\x20]*")
    whole = F.rtrim(value, F.lit(sep))
    stripped = F.split(whole, f"[\\x00-\\x20]*{pattern}[\\x00-\\x20]*")
    none = F.array().cast("array<string>")
    return (
        F.when(~F.endswith(value, F.lit(sep)), fields).when(whole == "", none).otherwise(stripped)
    )


def pad_right(value: Column, width: int) -> Column:
    """Pad with blanks to `width`; longer text is left whole."""
    return F.when(F.length(value) < width, F.rpad(value, width, " ")).otherwise(value)


def normalised(value: Column, strip: str, delims: str) -> Column:
    """Delete every character of `strip`, turn every delimiter into a blank, and lower-case."""
    to_blank = "".join(c for c in delims if c not in strip and c != " ")
    if strip:
        value = F.regexp_replace(value, f"{_char_class(strip)}+", "")
    if to_blank:
        value = F.regexp_replace(value, _char_class(to_blank), " ")
    return F.lower(value)


def _char_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in dict.fromkeys(chars)) + "]"
