"""Tables that join bucket by bucket, and files left out by a range."""

import datetime as dt
import re
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import colocated_join, read_clustered, write_clustered, write_colocated
from tallymark.session import scratch_path


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark, n):
    third = F.col("id") % 3
    key = F.when(third == 0, F.lit(None)).when(third == 1, 7).otherwise(F.col("id") % 3_000 + 100)
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


def name():
    return f"t{uuid.uuid4().hex}"


@pytest.mark.parametrize("how", ["inner", "left"])
def test_colocated_rows_and_plan(spark, no_broadcast, how):
    fact, table = skewed(spark, 9_000), name()
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (None, "n"), *[(k, f"t{k}") for k in range(100, 2_000)]], "k long, t string")
    write_colocated(fact, {"titles": dim}, "k", table, scratch_path(spark, table), 16)
    joined = colocated_join(spark, table, "titles", "k", how)
    assert rows(joined) == rows(fact.join(dim, "k", how))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    some = colocated_join(spark, table, "titles", "k", "inner", F.col("t") > "t1")
    assert rows(some) == rows(fact.join(dim.filter("t > 't1'"), "k"))
    with pytest.raises(ValueError):
        colocated_join(spark, table, "titles", "k", "full")
    with pytest.raises(ValueError):
        write_colocated(fact, {"fact": dim}, "k", table, "x")


def test_no_bucket_is_much_larger_than_the_others(spark, no_broadcast):
    table = name()
    dim = spark.range(0, 4_000).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    write_colocated(skewed(spark, 300_000), {"d": dim}, "k", table, scratch_path(spark, table), 32)
    by_file = spark.table(f"{table}_fact").groupBy(F.input_file_name()).count()
    counts = sorted(r["count"] for r in by_file.collect())
    assert len(counts) == 32 and sum(counts) == 300_000 and counts[-1] <= 4 * counts[16]
    # Writing again replaces the tables.
    write_colocated(skewed(spark, 300), {"d": dim}, "k", table, scratch_path(spark, table), 4)
    assert spark.table(f"{table}_fact").count() == 300


def test_empty_tables(spark):
    table, empty = name(), skewed(spark, 30).limit(0)
    dim = spark.createDataFrame([], "k long, t string")
    write_colocated(empty, {"d": dim}, "k", table, scratch_path(spark, table), 2)
    assert colocated_join(spark, table, "d", "k", "left").count() == 0
    path = scratch_path(spark, "clustered")
    write_clustered(empty, path, ["k", "v"], 4)
    assert read_clustered(spark, path, {"v": (1, 2)}).columns == ["k", "v"]
    assert read_clustered(spark, path, {}).count() == 0


def measured(spark, n=40_000):
    """Days of ten years and customers, in no order of either; some are null."""
    day = F.expr("date_add(date'2015-01-01', cast(pmod(xxhash64(id), 3650) as int))")
    return spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 50 > 0, day.cast("timestamp_ntz")).alias("at"),
        F.when(F.col("id") % 70 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5_000))).alias("who"),
        F.col("id"),
        day.alias("day"),
    )


def test_a_range_opens_few_files_and_loses_no_row(spark):
    df, path = measured(spark), scratch_path(spark, "clustered")
    write_clustered(df, path, ["at", "who"], 64)
    there = len(spark.read.parquet(f"{path}/data").inputFiles())
    assert there == 64
    year = (dt.datetime(2018, 1, 1), dt.datetime(2019, 1, 1))
    cases = [({"at": year}, 20), ({"who": (100, 200)}, 20), ({"at": year, "who": (100, 200)}, 6), ({}, 64)]
    cases += [({"at": (None, dt.datetime(2015, 3, 1))}, 20), ({"who": (4_990, None)}, 20)]
    for ranges, most in cases:
        got = read_clustered(spark, path, ranges)
        want = df
        for col, (low, high) in ranges.items():
            want = want.filter(F.col(col) >= low) if low is not None else want
            want = want.filter(F.col(col) < high) if high is not None else want
        assert rows(got) == rows(want) and got.count() > 0
        assert len(got.inputFiles()) <= most
    assert read_clustered(spark, path, {"who": (9_000, None)}).count() == 0


def test_other_types_and_refusals(spark):
    df = measured(spark, 2_000).withColumn("price", (F.col("id") / 7).cast("decimal(10,2)"))
    path = scratch_path(spark, "clustered")
    write_clustered(df, path, ["day", "price", "who"], 27)
    got = read_clustered(spark, path, {"day": (dt.date(2016, 1, 1), dt.date(2017, 1, 1)), "price": (10, 100)})
    want = df.filter("day >= date'2016-01-01' and day < date'2017-01-01' and price >= 10 and price < 100")
    assert rows(got) == rows(want) and want.count() > 0
    with pytest.raises(ValueError, match="text is string"):
        write_clustered(df.withColumn("text", F.lit("x")), path, ["text"])
    assert not re.search("Python", got._jdf.queryExecution().toString())
