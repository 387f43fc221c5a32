"""Movie-rating queries.

Inputs are typed frames: ratings(user_id, movie_id, rating, ts), movies(movie_id, title, genres),
users(user_id, gender, age, occupation, zip), occupations(occupation, name).
`scale=2` sums ratings as exact hundredths; without it they are summed as they are.
`salts` splits hot users over that many tasks, `hot` lets the adaptive split do so, and `isolate` looks
for hot users and null keys and splits those, see `lookup`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import FIVE_BANDS, FOUR_BANDS, bucketize, epoch_year, relabel
from tallymark.operators import (
    attach_title,
    avg_by_lookup,
    avg_by_multivalue,
    avg_count_by,
    best_with_min_support,
    bucketed_avg_wide,
    conditional_avg,
    fresh_rows,
    lookup,
    one_per_key,
)
from tallymark.sources import read_delimited

RATINGS = "user_id string, movie_id string, rating double, ts string"
MOVIES = "movie_id string, title string, genres string"
USERS = "user_id string, gender string, age int, occupation string, zip string"
OCCUPATIONS = "occupation string, name string"

# How a text input is read: `trimmed` strips fields, skips short lines and fails on a bad number;
# `lenient` drops any line that does not parse; `strict` fails on it, and `exact` also fails on a
# line with more fields than the schema.
READING = {
    "trimmed": dict(trim=True, on_short="drop", on_bad="fail"),
    "lenient": dict(trim=False, on_short="drop", on_bad="drop"),
    "strict": dict(trim=False, on_short="fail", on_bad="fail"),
    "exact": dict(trim=False, exact=True, on_short="fail", on_bad="fail"),
}


def load_ratings(
    spark: SparkSession, paths: str | Sequence[str], reading: str, with_ts: bool = False
) -> DataFrame:
    """Ratings of several files or globs as one input."""
    pick = ["user_id", "movie_id", "rating", *(["ts"] if with_ts else [])]
    return read_delimited(spark, paths, RATINGS, pick=pick, **READING[reading])


def load_movies(
    spark: SparkSession, paths: str | Sequence[str], reading: str, with_genres: bool = False
) -> DataFrame:
    pick = ["movie_id", "title", *(["genres"] if with_genres else [])]
    return read_delimited(spark, paths, MOVIES, pick=pick, **READING[reading])


def load_users(
    spark: SparkSession, paths: str | Sequence[str], reading: str, attr: str
) -> DataFrame:
    """Users with one attribute; a row whose attribute does not parse is dropped alone."""
    options = {**READING[reading], "on_bad": "fail" if reading in ("strict", "exact") else "drop"}
    return read_delimited(spark, paths, USERS, pick=["user_id", attr], **options)


def load_occupations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, paths, OCCUPATIONS, **READING["lenient"])


def movie_averages(ratings: DataFrame, movies: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean and number of ratings per rated movie; a movie without a title row is `Unknown`."""
    means = avg_count_by(ratings, "movie_id", "rating", scale)
    return attach_title(means, movies, "movie_id", "title")


def best_movie(
    ratings: DataFrame, movies: DataFrame, support: int = 5, scale: int | None = None
) -> DataFrame:
    """The best-rated movie among those with at least `support` ratings: one row or none."""
    best = best_with_min_support(ratings, "movie_id", "rating", support, scale)
    return attach_title(best, movies, "movie_id", "title", few=True)


def genre_averages(
    ratings: DataFrame, movies: DataFrame, sep: str = "|", scale: int | None = None
) -> DataFrame:
    """Mean and number of ratings per genre, by genre."""
    return (
        avg_by_multivalue(ratings, movies, "movie_id", "genres", "rating", sep, scale)
        .withColumnRenamed("genres", "genre")
        .orderBy("genre")
    )


def gender_averages_wide(
    ratings: DataFrame,
    movies: DataFrame,
    users: DataFrame,
    labels: dict[str, str] | None = None,
    scale: int | None = None,
    salts: int = 1,
    hot: bool = False,
    isolate: bool = False,
) -> DataFrame:
    """Male and female mean per movie; ratings by anyone else count in neither."""
    labels = labels or {"male": "M", "female": "F"}
    # Users of another label are dropped before the join, after one row per user is picked.
    picked = one_per_key(users.select("user_id", "gender"), "user_id", many=isolate)
    wanted = picked.filter(F.upper("gender").isin([x.upper() for x in labels.values()]))
    wanted = fresh_rows(wanted) if hot else wanted
    rated = lookup(ratings, wanted, "user_id", ["gender"], "inner", salts=salts, isolate=isolate)
    wide = conditional_avg(rated, "movie_id", "gender", labels, "rating", scale)
    return attach_title(wide, movies, "movie_id", "title", many=isolate)


def age_band_averages_wide(
    ratings: DataFrame,
    movies: DataFrame,
    users: DataFrame,
    scale: int | None = None,
    salts: int = 1,
    hot: bool = False,
    isolate: bool = False,
) -> DataFrame:
    """Mean per movie and age band, one column per band; unrated movies stay, with nulls."""
    bands = users.select("user_id", bucketize(F.col("age"), *FOUR_BANDS).alias("band"))
    rated = lookup(ratings, bands, "user_id", ["band"], "inner", True, salts, hot, isolate)
    titles = movies.select("movie_id", "title")
    labels = FOUR_BANDS.labels
    return bucketed_avg_wide(rated, titles, "movie_id", "band", labels, "rating", scale, many=isolate)


def movie_averages_known(
    ratings: DataFrame, movies: DataFrame, scale: int | None = None
) -> DataFrame:
    """Mean and number of ratings per movie that has a title row."""
    means = avg_count_by(ratings, "movie_id", "rating", scale)
    return attach_title(means, movies, "movie_id", "title", "inner")


def gender_averages_long(
    ratings: DataFrame,
    movies: DataFrame,
    users: DataFrame,
    scale: int | None = None,
    salts: int = 1,
    isolate: bool = False,
) -> DataFrame:
    """Mean per movie and gender as written in the user table, with the title."""
    rated = lookup(ratings, users, "user_id", ["gender"], "inner", salts=salts, isolate=isolate)
    means = avg_count_by(rated, ["movie_id", "gender"], "rating", scale)
    return attach_title(means, movies, "movie_id", "title", "inner")


def gender_names(means: DataFrame) -> DataFrame:
    """`M` spelled out as Male, anything else as Female."""
    return means.withColumn("gender", relabel(F.col("gender")))


def age_band_averages_long(
    ratings: DataFrame,
    movies: DataFrame,
    users: DataFrame,
    scale: int | None = None,
    salts: int = 1,
    isolate: bool = False,
) -> DataFrame:
    """Mean per movie and one of five age bands, with the title."""
    known = users.filter(F.col("age").isNotNull())
    bands = known.select("user_id", bucketize(F.col("age"), *FIVE_BANDS).alias("band"))
    rated = lookup(ratings, bands, "user_id", ["band"], "inner", salts=salts, isolate=isolate)
    means = avg_count_by(rated, ["movie_id", "band"], "rating", scale)
    return attach_title(means, movies, "movie_id", "title", "inner")


def occupation_averages(
    ratings: DataFrame, users: DataFrame, scale: int | None = None
) -> DataFrame:
    """Mean and number of ratings per occupation code, most ratings first."""
    means = avg_by_lookup(ratings, users, "user_id", "occupation", "rating", scale)
    return means.orderBy(F.desc("n"), "occupation")


def occupation_averages_named(
    ratings: DataFrame, users: DataFrame, occupations: DataFrame, scale: int | None = None
) -> DataFrame:
    """The same with the occupation's name; null where the code has none."""
    means = avg_by_lookup(ratings, users, "user_id", "occupation", "rating", scale)
    named = lookup(means, occupations, "occupation", ["name"], "left", unique=True)
    return named.orderBy(F.desc("n"), "occupation")


def year_averages(ratings: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean and number of ratings per UTC year of the epoch-seconds text `ts`, by year."""
    dated = ratings.withColumn("year", epoch_year(F.col("ts"))).filter(F.col("year").isNotNull())
    return avg_count_by(dated, "year", "rating", scale).orderBy("year")


def first_rows(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The first n rows by the given keys."""
    return df.orderBy(*keys).limit(n)
