"""Hot and null keys: what the sketch finds, the rows of the isolating join, and how even its tasks are."""

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import (
    attach_title,
    bucketed_avg_wide,
    frequent_keys,
    isolating_join,
    lookup,
)
from tallymark.plans import movies as m


def fact(spark, n, hot=3, nulls=3, keys=5000):
    """n rows: a third with a null key, a third with key 7, the others spread."""
    third = F.col("id") % max(hot, nulls)
    key = F.when(third == 0, F.lit(None)).when(third == 1, 7).otherwise(F.col("id") % keys + 100)
    return spark.range(0, n, 1, 16).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture
def many_tasks(spark):
    names = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_frequent_keys_of_a_known_table(spark):
    found = frequent_keys(fact(spark, 90_000), "k", 0.01)
    assert (found.rows, found.nulls) == (90_000, 30_000)
    assert [k for k, _ in found.keys] == [7] and abs(found.keys[0][1] - 30_000) <= 0.0025 * 90_000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_frequent_key_is_missed(spark, seed):
    rng = random.Random(seed)
    values = [str(int(rng.paretovariate(0.7))) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(7)
    counts, share = Counter(values), 0.004
    found = frequent_keys(df, "k", share)
    must = {k for k, n in counts.items() if n >= share * len(values)}
    may = {k for k, n in counts.items() if n >= share / 2 * len(values)}
    assert must <= {k for k, _ in found.keys} <= may
    assert all(abs(n - counts[k]) <= share / 4 * len(values) for k, n in found.keys)


def test_frequent_keys_of_odd_tables(spark):
    empty = spark.createDataFrame([], "k string, a array<int>")
    assert frequent_keys(empty, "k") == (0, 0, [])
    assert frequent_keys(spark.createDataFrame([(None,)] * 3, "k int"), "k") == (3, 3, [])
    assert frequent_keys(spark.sql("select date'2024-01-01' `a b`"), "a b").keys[0][1] == 1
    with pytest.raises(ValueError):
        frequent_keys(empty, "a")
    with pytest.raises(ValueError):
        frequent_keys(empty, "k", 0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_are_those_of_the_plain_join(spark, many_tasks, how):
    left = fact(spark, 6_000)
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (None, "n"), *[(k, f"t{k}") for k in range(100, 2_000)]], "k long, t string")
    assert rows(isolating_join(left, dim, "k", how)) == rows(left.join(dim, "k", how))
    even = left.filter("k > 7")
    assert rows(isolating_join(even, dim, "k", how)) == rows(even.join(dim, "k", how))
    for side in (left.limit(0), left):
        empty = dim.limit(0)
        assert rows(isolating_join(side, empty, "k", how)) == rows(side.join(empty, "k", how))
    assert isolating_join(left, dim, "k", how).columns == left.join(dim, "k", how).columns
    with pytest.raises(ValueError):
        isolating_join(left, dim, "k", "full")


def rows_by_task(df):
    """Rows of the result that each task of its last stage made."""
    counted = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted(r["count"] for r in counted)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_no_task_has_more_than_four_times_the_median(spark, many_tasks, how):
    left, dim = fact(spark, 400_000), spark.range(0, 6_000).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    plain = rows_by_task(left.join(dim, "k", how))
    assert plain[-1] > 10 * plain[len(plain) // 2]
    tasks = rows_by_task(isolating_join(left, dim, "k", how))
    assert len(tasks) == 64 and tasks[-1] <= 4 * tasks[32]


def test_lookup_isolates_and_picks_one_row(spark, many_tasks):
    left = fact(spark, 3_000)
    dim = spark.createDataFrame([(7, "a")] * 50 + [(7, "z"), (None, "n"), (None, "m"), (101, "t")], "k long, t string")
    plain = lookup(left, dim, "k", ["t"], "left", unique=True)
    assert rows(lookup(left, dim, "k", ["t"], "left", unique=True, isolate=True)) == rows(plain)


def test_a_dimension_key_that_many_rows_share_is_combined_before_the_shuffle(spark, many_tasks):
    ids = spark.range(0, 60_000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    titles = ids.select(key.alias("k"), F.col("id").cast("string").alias("title"))
    means = spark.createDataFrame([(7, "a", 1.0), (11, "b", 2.0)], "k long, band string, r double")
    wide = bucketed_avg_wide(means, titles, "k", "band", ["a", "b"], "r", many=True)
    assert rows(wide) == rows(bucketed_avg_wide(means, titles, "k", "band", ["a", "b"], "r"))
    few = means.groupBy("k").agg(F.sum("r").alias("r"))
    assert rows(attach_title(few, titles, "k", "title", many=True)) == rows(attach_title(few, titles, "k", "title"))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("partial_max") == 1


def test_movie_plans_take_the_option(spark, many_tasks):
    ratings = spark.range(4_000).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 'u1', concat('u', id % 97))) as user_id",
        "cast(id % 5 as string) as movie_id", "cast(id % 9 as double) / 2 as rating")
    movies = spark.range(7).selectExpr("cast(id as string) as movie_id", "concat('m', id) as title")
    users = spark.range(90).selectExpr(
        "concat('u', id) as user_id", "if(id % 2 = 0, 'M', 'F') as gender", "cast(id as int) as age")
    for plan in (m.gender_averages_wide, m.age_band_averages_wide, m.gender_averages_long, m.age_band_averages_long):
        assert rows(plan(ratings, movies, users, isolate=True)) == rows(plan(ratings, movies, users))
