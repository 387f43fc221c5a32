"""Every registered query against its SQL, on the given tables and on a skewed copy of them."""

import pytest
from check_oracle import compare, connect
from make_skewed import make_skewed

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from tallymark.plans.registry import QUERIES

PLAIN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    make_skewed(PLAIN, folder)
    return folder


def queries():
    return QUERIES


def test_every_query_has_sql():
    assert set(queries()) <= set(oracle_sql()) and set(oracle_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, name):
    assert compare(queries()[name](spark, PLAIN), connect(PLAIN), oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql_on_skewed_tables(spark, skewed, name):
    assert compare(queries()[name](spark, skewed), connect(skewed), oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["movie_id", "avg", "n", "title"] and df.count() > 0


def test_word_counts_per_category_add_up(spark):
    from tallymark.plans import reviews as r
    from tallymark.plans import tables as t

    felt = t.felt_reviews(spark, PLAIN)
    total = felt.count()
    assert sum(x.num_comments for x in r.comments_by(felt, "category").collect()) == total
    assert sum(x.num_comments for x in r.comments_by(felt, "aspect").collect()) == total
    words = {}
    for sentiment in (None, "positive", "negative", "neutral"):
        top = r.top_words_by_category(felt, t.STOPWORDS, sentiment, 10**6, t.DELIMS)
        words[sentiment] = {(x.category, x.word): x.frequency for x in top.collect()}
    for key, n in words[None].items():
        parts = [words[s].get(key, 0) for s in ("positive", "negative", "neutral")]
        assert sum(parts) == n
