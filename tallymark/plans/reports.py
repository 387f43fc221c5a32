"""Report lines: the only place where a null turns into a display value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import FOUR_BANDS, pad_right, two_decimals

# The formats of the report lines, and what stands for a missing mean.
MOVIE_AVERAGE = "Average rating: %s (Total ratings: %d)"
BEST_MOVIE = (
    "is the highest rated movie with an average rating of %s among movies with at least "
    "{support} ratings."
)
GENRE_AVERAGE = "Avg: %s, Count: %d"
GENDER_WIDE = "  Male: %s, Female: %s"
AGE_BAND_WIDE = "  ".join(f"{label}: %s" for label in FOUR_BANDS.labels)
MOVIE_AVERAGE_BLOCK = "%s: \n\t+Avg, rating: %s\n\t+Times of rating: %d"
GENDER_BLOCK = "Movie: %s \n\t+Gender: %s\n\t+Avg rating: %s"
THREE_COLUMNS = "%s | %s | %s"
COUNTED = "%s | %s        | %d"
SCORE_AVERAGE = "Average Review Score: %s"
SCORE_COUNT = "Score %d: %d reviews"
NO_GENDER = "0.00"
NO_BAND = "NA"


def report_line(
    df: DataFrame, fmt: str, cols: Sequence[Column], keep: Sequence[str] = ()
) -> DataFrame:
    """`keep` columns and one `line` built by `fmt`, whose fields take the given columns."""
    return df.select(*keep, F.format_string(fmt, *cols).alias("line"))


def _two(name: str, missing: str = "", ties: str = "up") -> Column:
    return F.coalesce(two_decimals(F.col(f"`{name}`"), ties), F.lit(missing))


def _even(name: str) -> Column:
    return _two(name, ties="even")


def _plain(name: str) -> Column:
    return F.col(name).cast("string")


def movie_average_lines(means: DataFrame) -> DataFrame:
    """`title` and `line` of a text sink, in key order."""
    cols = [_plain("avg"), F.col("n")]
    return report_line(means.orderBy("movie_id"), MOVIE_AVERAGE, cols, ["title"])


def best_movie_lines(best: DataFrame, support: int = 5) -> DataFrame:
    return report_line(best, BEST_MOVIE.format(support=support), [_plain("avg")], ["title"])


def genre_lines(means: DataFrame) -> DataFrame:
    cols = [_two("avg"), F.col("n")]
    return report_line(means.orderBy("genre"), GENRE_AVERAGE, cols, ["genre"])


def gender_wide_lines(means: DataFrame) -> DataFrame:
    cols = [_two("male", NO_GENDER), _two("female", NO_GENDER)]
    return report_line(means.orderBy("movie_id"), GENDER_WIDE, cols, ["title"])


def age_band_wide_lines(means: DataFrame) -> DataFrame:
    cols = [_two(label, NO_BAND) for label in FOUR_BANDS.labels]
    return report_line(means.orderBy("movie_id"), AGE_BAND_WIDE, cols, ["title"])


def movie_average_blocks(means: DataFrame) -> DataFrame:
    return report_line(means, MOVIE_AVERAGE_BLOCK, [F.col("title"), _plain("avg"), F.col("n")])


def gender_blocks(means: DataFrame) -> DataFrame:
    return report_line(means, GENDER_BLOCK, [F.col("title"), F.col("gender"), _even("avg")])


def gender_lines(means: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    title = pad_right(F.substring("title", 1, 30), 30)
    cols = [title, pad_right(F.col("gender"), 7), _even("avg")]
    return report_line(means, THREE_COLUMNS, cols, keep)


def age_band_lines(means: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    title = pad_right(F.substring("title", 1, 33), 35)
    cols = [title, pad_right(F.col("band"), 12), _even("avg")]
    return report_line(means, THREE_COLUMNS, cols, keep)


def occupation_lines(means: DataFrame) -> DataFrame:
    cols = [pad_right(_plain("occupation"), 20), _even("avg"), F.col("n")]
    return report_line(means, COUNTED, cols)


def year_lines(means: DataFrame) -> DataFrame:
    return report_line(means, COUNTED, [pad_right(_plain("year"), 10), _even("avg"), F.col("n")])


def score_lines(summary: DataFrame) -> DataFrame:
    """The mean score, then the number of reviews per score."""
    head = F.format_string(SCORE_AVERAGE, _even("avg"))
    count = F.format_string(SCORE_COUNT, F.col("score"), F.col("n"))
    line = F.when(F.col("score").isNull(), head).otherwise(count)
    return summary.orderBy(F.asc_nulls_first("score")).select(line.alias("line"))
