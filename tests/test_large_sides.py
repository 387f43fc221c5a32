"""Membership filter, distinct counts by bitmaps and places: rows against plain plans, and what is shuffled."""

import contextlib
import io
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import (
    distinct_by,
    distinct_totals,
    drop_members,
    drop_stopwords,
    membership,
    membership_filter,
    numbered_values,
    revenue_by,
    with_places,
)


def plan(df):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()


def zipf(spark, n, words):
    """n words, the frequent ones very frequent; some are null."""
    rank = F.floor(F.pow(F.lit(float(words)), F.rand(3)))
    word = F.when(F.rand(4) > 0.02, F.concat(F.lit("w"), rank.cast("string")))
    return spark.range(0, n, 1, 8).select(F.col("id"), word.alias("word")).checkpoint()


@pytest.fixture(scope="module")
def tokens(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return zipf(spark, 60_000, 20_000)


def table(spark, n):
    """Every other word up to 2n, some of them twice, and a null."""
    words = spark.range(n).select(F.concat(F.lit("w"), (F.col("id") * 2).cast("string")).alias("stop"))
    return words.union(words.limit(10)).union(spark.sql("select cast(null as string)"))


@pytest.mark.parametrize("n", [0, 10, 9_000])
@pytest.mark.parametrize("bits", [1 << 10, 1 << 25])
@pytest.mark.parametrize("bytes_", [32 << 20, -1])
def test_rows_are_those_of_the_anti_join(spark, tokens, monkeypatch, n, bits, bytes_):
    monkeypatch.setattr(membership, "MOST_BYTES", bytes_)
    got = drop_members(tokens, table(spark, n), "word", bits)
    assert got.columns == tokens.columns
    assert rows(got) == rows(drop_stopwords(tokens, table(spark, n).distinct()))


def test_other_types_and_empty_rows(spark):
    numbers = spark.range(100).select(F.col("id").cast("int").alias("n"))
    assert rows(drop_members(numbers, spark.range(0, 100, 2).select(F.col("id").cast("int")), "n")) == [
        (n,) for n in sorted(range(1, 100, 2), key=lambda n: repr((n,)))
    ]
    assert drop_members(numbers.limit(0), numbers, "n").count() == 0


def test_the_filter_is_bounded_and_misses_nothing(spark):
    values = spark.range(200_000).select(F.col("id").cast("string").alias("v"))
    small, bits = membership_filter(values, "v", 1 << 12)
    assert bits == 1 << 12 and small.count() <= 64
    whole, bits = membership_filter(values, "v")
    assert 8 * 200_000 <= bits <= 32 * 200_000 * 1.1
    set_ = whole.agg(F.sum(F.bit_count("_bits"))).first()[0]
    assert 0.9 * 200_000 < set_ <= 200_000


def test_no_token_is_shuffled(spark, tokens):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = plan(drop_stopwords(tokens, table(spark, 9_000).distinct()))
        assert "Exchange hashpartitioning" in plain.replace("\n", " ") or "Arguments: hashpartitioning(word" in plain
        text = plan(drop_members(tokens, table(spark, 9_000), "word"))
        assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SHAPE = "g string, n long, day date, small smallint, text string, price double"


def measured(spark):
    out = []
    for i in range(3_000):
        n = None if i % 11 == 0 else (i * i) % 700 - 350
        g = None if i % 50 == 0 else f"g{i % 7}"
        out.append((g, n, None, i % 5, None if i % 13 == 0 else f"t{i % 321}", float(i % 4)))
    days = F.expr("if(n % 3 = 0, null, date_add(date'1969-06-01', cast(n as int)))")
    return spark.createDataFrame(out, SHAPE).withColumn("day", days).repartition(5)


@pytest.mark.parametrize("col", ["n", "day", "small"])
def test_distinct_counts_by_group(spark, col):
    df = measured(spark)
    want = df.groupBy("g").agg(F.countDistinct(col).alias("c"), F.sum("price").alias("s"))
    got = distinct_by(df, ["g"], col, "c", s=F.sum("price"))
    assert got.dtypes[1] == ("c", "bigint") and rows(got) == rows(want)
    assert rows(distinct_by(df.limit(0), ["g"], col, "c")) == []


def test_extreme_numbers(spark):
    edge = [-(1 << 63), (1 << 63) - 1, -1, 0, 63, 64, -64, -65, None]
    df = spark.createDataFrame([(v,) for v in edge + edge], "v long")
    assert rows(distinct_totals(df, {"a": "v"})) == [("a", 9)]
    assert rows(distinct_totals(df, {"a": "v"}, count_null=False, rows="r")) == [("a", 8), ("r", 18)]


def test_totals_of_several_columns_and_types(spark):
    df = measured(spark)
    whole, mixed = {"n": "n", "day": "day", "small": "small"}, {"n": "n", "text": "text"}
    for cols in (whole, mixed):
        for nulls in (True, False):
            want = [(m, df.select(c).distinct().count() if nulls else df.select(c).na.drop().distinct().count())
                    for m, c in cols.items()]
            got = [tuple(r) for r in distinct_totals(df, cols, nulls, "rows").collect()]
            assert got == [("rows", 3_000), *want]
            empty = distinct_totals(df.limit(0), cols, nulls, "rows").collect()
            assert [r.total for r in empty] == [0] * (1 + len(cols))
    assert [r.total for r in distinct_totals(spark.sql("select cast(null as int) v"), {"a": "v"}).collect()] == [1]


def test_revenue_with_distinct_text_through_a_dictionary(spark):
    df = measured(spark).withColumn("freight", F.lit(0.5))
    plain = revenue_by(df, ["g"], "price", "freight", "text")
    assert rows(revenue_by(df, ["g"], "price", "freight", "text", dictionary=True)) == rows(plain)
    numbered = numbered_values(df, "text", "number")
    assert numbered.count() == 3_000 and numbered.select("number").distinct().count() == 322
    assert numbered.filter("(number is null) != (text is null)").count() == 0


def test_no_shuffle_carries_values_and_no_column_is_expanded(spark):
    items = spark.range(1000).selectExpr("id % 5 as s", "id as o", "1.5D as p", "0.5D as f")
    for df in (revenue_by(items, ["s"], "p", "f", "o"), distinct_totals(items, {"a": "o", "b": "s"}, rows="r")):
        text = plan(df)
        assert "Expand" not in text
        for keys in re.findall(r"hashpartitioning\((.*?), \d+\)", text):
            assert not re.search(r"\bo#", keys)


def test_dense_values_are_shuffled_64_to_a_row(spark):
    items = spark.range(0, 64_000, 1, 4).selectExpr("id % 4 as s", "id div 4 as o")
    words = items.groupBy("s", F.shiftright("o", 6)).agg(F.bit_or("o"))
    assert words.count() == 4 * 250
    assert rows(distinct_by(items, ["s"], "o", "c")) == [(s, 16_000) for s in range(4)]


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_places_follow_the_order(spark, n):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df = spark.range(0, n, 1, 6).select(((F.col("id") * 7919) % 5_003).alias("v"), F.col("id").alias("w"))
        got = with_places(df.orderBy(F.desc("v"), "w"), "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = sorted(((i * 7919) % 5_003, i) for i in range(n))
    want.sort(key=lambda r: (-r[0], r[1]))
    assert sorted(tuple(r) for r in got) == sorted((*r, i) for i, r in enumerate(want, 1))


def test_places_of_limited_and_grouped_results(spark):
    df = spark.range(100).orderBy(F.desc("id")).limit(3)
    assert rows(with_places(df)) == [(97, 3), (98, 2), (99, 1)]
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().orderBy("k")
    assert sorted((r.k, r.place) for r in with_places(counts).collect()) == [(k, k + 1) for k in range(10)]
