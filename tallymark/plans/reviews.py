"""Hotel-review queries over reviews(id, review, aspect, category, sentiment)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import (
    count_by,
    drop_members,
    drop_stopwords,
    most_frequent,
    tokenize,
    top_n,
    top_n_per_group,
)
from tallymark.operators.tokens import WORD_DELIMS
from tallymark.sources import read_delimited

REVIEWS = "id string, review string, aspect string, category string, sentiment string"
STOPWORDS = "word string"
# The sentiments that make a row a review.
SENTIMENTS = ("positive", "negative", "neutral")

# How a text input is read: an empty field is null, so a review without an id is dropped.
READING = dict(sep=";", trim=False, on_short="keep", on_bad="keep", empty_as_null=True)

Stopwords = DataFrame | Iterable[str]


def load_reviews(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Semicolon-separated reviews; the header row and rows of no known sentiment are dropped."""
    return known_reviews(read_delimited(spark, paths, REVIEWS, **READING))


def known_reviews(raw: DataFrame) -> DataFrame:
    kept = raw.filter((F.col("id") != "id") & F.col("sentiment").isin(*SENTIMENTS))
    return kept.withColumn("id", F.col("id").try_cast("int"))


def load_stopwords(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One stopword per line, up to the first semicolon."""
    return read_delimited(spark, paths, STOPWORDS, sep=";", trim=False)


def clean_words(
    reviews: DataFrame,
    stopwords: Stopwords,
    delims: str = WORD_DELIMS,
    salts: int = 1,
    filtered: bool = False,
) -> DataFrame:
    """One row per word that is not a stopword. No shuffle unless the stopword table is large.

    `filtered=True` shuffles no word even then, for a pass over the words beforehand, see `drop_members`.
    """
    words = tokenize(reviews, "review", ["id", "aspect", "category", "sentiment"], delims=delims)
    if filtered and isinstance(stopwords, DataFrame):
        return drop_members(words, stopwords, "word")
    return drop_stopwords(words, stopwords, salts=salts)


def word_counts(
    reviews: DataFrame, stopwords: Stopwords, delims: str = WORD_DELIMS
) -> DataFrame:
    """Frequency of every word that is not a stopword."""
    return _counts(reviews, ["word"], stopwords, delims)


def top_words(
    reviews: DataFrame, stopwords: Stopwords, n: int = 5, delims: str = WORD_DELIMS, cut: bool = False
) -> DataFrame:
    """The n most frequent words. `cut=True` counts only those that may be among them, see `most_frequent`."""
    if cut:
        return most_frequent(_kept_words(reviews, ["id"], stopwords, delims), [], "word", n)
    return top_n(word_counts(reviews, stopwords, delims), n, "frequency", ["word"])


def comments_by(reviews: DataFrame, attr: str) -> DataFrame:
    """Number of reviews per category or aspect."""
    return count_by(reviews, attr, "id", "num_comments")


def leading_aspect(reviews: DataFrame, sentiment: str) -> DataFrame:
    """The aspect with the most reviews of one sentiment."""
    felt = reviews.filter(F.col("sentiment") == sentiment)
    counts = count_by(felt, ["aspect", "sentiment"], "id", "frequency")
    return top_n(counts, 1, "frequency", ["aspect"])


def top_words_by_category(
    reviews: DataFrame,
    stopwords: Stopwords,
    sentiment: str | None = None,
    n: int = 5,
    delims: str = WORD_DELIMS,
    cut: bool = False,
) -> DataFrame:
    """The n most frequent words per category, over all reviews or those of one sentiment; `cut` as in
    `top_words`."""
    felt = reviews if sentiment is None else reviews.filter(F.col("sentiment") == sentiment)
    if cut:
        words = _kept_words(felt, ["id", "category"], stopwords, delims)
        return most_frequent(words, "category", "word", n)
    counts = _counts(felt, ["category", "word"], stopwords, delims)
    return top_n_per_group(counts, "category", n, "frequency", ["word"])


def _kept_words(reviews: DataFrame, keep: Sequence[str], stopwords: Stopwords, delims: str) -> DataFrame:
    """The words that are no stopwords, of reviews that have an id; none is shuffled."""
    words = tokenize(reviews.filter(F.col("id").isNotNull()), "review", keep, delims=delims)
    if isinstance(stopwords, DataFrame):
        return drop_members(words, stopwords, "word")
    return drop_stopwords(words, stopwords)


def _counts(reviews: DataFrame, keys: Sequence[str], stopwords: Stopwords, delims: str):
    keep = ["id", *[k for k in keys if k != "word"]]
    words = tokenize(reviews, "review", keep, delims=delims)
    if not isinstance(stopwords, DataFrame):
        return count_by(drop_stopwords(words, stopwords), keys, "id", "frequency")
    # Whether a word is a stopword does not depend on its count: join the few counted words.
    return drop_stopwords(count_by(words, keys, "id", "frequency"), stopwords)
