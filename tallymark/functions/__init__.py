from tallymark.functions.bands import FIVE_BANDS, FOUR_BANDS, Bands, bucketize, relabel
from tallymark.functions.dates import epoch_year, year_range
from tallymark.functions.numbers import mean, summable, two_decimals, unscaled
from tallymark.functions.text import (
    normalised,
    pad_right,
    separator_regex,
    split_fields,
    trim_blanks,
)

__all__ = [
    "FIVE_BANDS",
    "FOUR_BANDS",
    "Bands",
    "bucketize",
    "epoch_year",
    "mean",
    "normalised",
    "pad_right",
    "relabel",
    "separator_regex",
    "split_fields",
    "summable",
    "trim_blanks",
    "two_decimals",
    "unscaled",
    "year_range",
]
