import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tallymark.session import clear_scratch, scratch_path
from tallymark.sources import (
    delimited_lines,
    parse_delimited,
    read_csv,
    read_delimited,
    reject_lines,
    write_delimited,
    write_text,
)

RATINGS = "user_id string, movie_id string, rating double, ts string"
PICK = ["user_id", "movie_id", "rating"]


def test_trimmed_fields_short_and_blank_lines(lines):
    df = lines("1, 10, 4.0, 99", "", "   ", "2,11", "3, 12, 3.5 ", "4,13,,")
    got = parse_delimited(df, RATINGS, pick=PICK, on_bad="fail")
    assert rows(got) == [("1", "10", 4.0), ("3", "12", 3.5)]


def test_lenient_keeps_blanks_and_drops_bad_numbers(lines):
    df = lines("1, 10, 4.0, 99", "2,11,x,9", "3,12", "", "4,13,,1", "5,14,2.5")
    got = parse_delimited(df, RATINGS, pick=PICK, trim=False)
    assert rows(got) == [("1", " 10", 4.0), ("5", "14", 2.5)]


@pytest.mark.parametrize("bad", ["1,10", "1,10,x,9", ""])
def test_strict_fails(lines, bad):
    df = lines("1,10,4.0,99", bad)
    got = parse_delimited(df, RATINGS, pick=PICK, trim=False, on_short="fail", on_bad="fail")
    with pytest.raises(PySparkException):
        got.collect()


def test_strict_passes_sound_lines(lines):
    df = lines("1,10,4.0,99", "2,11,5")
    got = parse_delimited(df, RATINGS, pick=PICK, trim=False, on_short="fail", on_bad="fail")
    assert got.count() == 2


def test_exact_arity(lines):
    df = lines("1,a,b", "2,a,b,c")
    schema = "movie_id string, title string, genres string"
    assert rows(parse_delimited(df, schema, exact=True)) == [("1", "a", "b")]
    with pytest.raises(PySparkException):
        parse_delimited(df, schema, exact=True, on_short="fail").collect()


def test_unpicked_fields_are_not_required(lines):
    df = lines("1,M,old,3,zip", "2,F")
    schema = "user_id string, gender string, age int, occupation string, zip string"
    got = parse_delimited(df, schema, pick=["user_id", "gender"])
    assert rows(got) == [("1", "M"), ("2", "F")]
    assert rows(parse_delimited(df, schema, pick=["user_id", "age"])) == []


def test_keep_gives_nulls(lines):
    df = lines("1;a", "x;b;7")
    got = parse_delimited(df, "id int, name string, n int", sep=";", on_short="keep", on_bad="keep")
    assert rows(got) == [(1, "a", None), (None, "b", 7)]


def test_quotes_do_not_protect_separators(lines):
    got = parse_delimited(lines('1;"a;b"'), "id int, name string", sep=";", trim=False)
    assert rows(got) == [(1, '"a')]


def test_dropped_and_rejected_lines_add_up(lines):
    df = lines("1,10,4.0", "2,11,x", "3", "", "4,12,1e1", "5,13,nan")
    kept = parse_delimited(df, RATINGS, pick=PICK, trim=False)
    bad = reject_lines(df, RATINGS, pick=PICK, trim=False)
    assert rows(bad) == [("", "short"), ("2,11,x", "bad"), ("3", "short")]
    assert kept.count() + bad.count() == df.count()


def test_a_column_may_be_called_value(lines):
    df = lines("1,2.5", "2,x")
    assert rows(parse_delimited(df, "key string, value double")) == [("1", 2.5)]
    assert rows(reject_lines(df, "key string, value double")) == [("2,x", "bad")]


def test_unknown_column(lines):
    with pytest.raises(ValueError):
        parse_delimited(lines("1"), "a int", pick=["a", "b"])


def test_unknown_policy(lines):
    with pytest.raises(ValueError):
        parse_delimited(lines("1"), "a int", on_bad="ignore")


def test_glob_reads_files_as_one_input_with_crlf(spark, tmp_path):
    (tmp_path / "ratings_1.txt").write_bytes(b"1,10,4.0,9\r\n2,11,3.0,9")
    (tmp_path / "ratings_2.txt").write_bytes(b"3,12,2.0,9\r\n")
    got = read_delimited(spark, f"{tmp_path}/ratings_*.txt", RATINGS)
    assert rows(got) == [("1", "10", 4.0, "9"), ("2", "11", 3.0, "9"), ("3", "12", 2.0, "9")]
    both = [f"{tmp_path}/ratings_1.txt", f"{tmp_path}/ratings_2.txt"]
    assert rows(read_delimited(spark, both, RATINGS)) == rows(got)


def test_sinks_write_fields_as_they_are(spark):
    df = spark.createDataFrame([("a b", 1, None), ('q"', None, 2.5)], "k string, n int, x double")
    path = scratch_path(spark, "sink")
    write_delimited(df, path)
    assert rows(spark.read.text(path)) == [('a b;1;',), ('q";;2.5',)]
    write_text(df.select("k", "n"), path, "overwrite")
    assert rows(spark.read.text(path)) == [('a b\t1',), ('q"\t',)]
    assert delimited_lines(df, ",").columns == ["value"]


def test_csv_header_declared_and_inferred(spark, tmp_path):
    (tmp_path / "o.csv").write_text("Order_ID;Price\na;1.5\nb;\n")
    inferred = read_csv(spark, str(tmp_path / "o.csv"))
    assert inferred.dtypes == [("Order_ID", "string"), ("Price", "double")]
    declared = read_csv(spark, str(tmp_path / "o.csv"), schema="order_id string, price string")
    assert rows(declared) == [("a", "1.5"), ("b", None)]


def test_scratch_path_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    clear_scratch(spark)
