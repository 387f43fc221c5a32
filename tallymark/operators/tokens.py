"""Splitting text into words and dropping stopwords."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions import normalised
from tallymark.operators.rows import fresh_rows

# Punctuation that is deleted, and characters that separate words.
PUNCTUATION = "?!;,."
WORD_DELIMS = ' ",()*'
# A literal list up to this long becomes a hash-set test inside the scan stage, a longer one a
# table; the rows that are left are the same.
MAX_LITERAL_WORDS = 10_000


def tokenize(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    strip: str = PUNCTUATION,
    delims: str = WORD_DELIMS,
) -> DataFrame:
    """One row per word of the whole text, lower-case, with the `keep` columns.

    Characters of `strip` are deleted without leaving a gap. No shuffle.
    """
    clean = normalised(F.col(text), strip, delims)
    words = df.select(*keep, F.explode(F.split(clean, " ")).alias("word"))
    return words.filter(F.col("word") != "")


def drop_stopwords(
    tokens: DataFrame,
    stopwords: DataFrame | Iterable[str],
    col: str = "word",
    salts: int = 1,
) -> DataFrame:
    """Rows whose word is not a stopword.

    A list of words becomes a set test, or a table if it is long. A DataFrame (its first column)
    becomes an anti-join, whose side Catalyst broadcasts only if it is small. Words are few and
    some are very frequent: `salts` splits each word's rows over that many tasks, by the task that
    reads them, where the join shuffles.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    if not isinstance(stopwords, DataFrame):
        words = sorted(set(stopwords))
        if len(words) > MAX_LITERAL_WORDS:
            stopwords = tokens.sparkSession.createDataFrame([(w,) for w in words], f"{col} string")
    if isinstance(stopwords, DataFrame):
        # Each stopword once, however often the table repeats it.
        side = fresh_rows(stopwords.select(F.col(stopwords.columns[0]).alias(col)).distinct())
        if salts == 1:
            return tokens.join(side, col, "left_anti").select(*tokens.columns)
        salted = tokens.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        every = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return salted.join(every, [col, "_salt"], "left_anti").select(*tokens.columns)
    return tokens.filter(F.col(col).isNull() | ~F.col(col).isin(words))
