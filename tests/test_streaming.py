import pytest
from conftest import rows

from tallymark.session import scratch_path
from tallymark.streaming import (
    CORRUPT,
    ingest_ndjson,
    parse_ndjson,
    read_ndjson_socket,
    read_ndjson_stream,
    to_ndjson,
)

SCHEMA = "message string, n int"
LINES = ['{"message":"hi","n":1}', "{broken", "", '{"message":"x","extra":true}', '{"n":"no"}', "[1]"]


def test_batch_parse(lines):
    got = parse_ndjson(lines(*LINES), SCHEMA)
    assert got.columns == ["message", "n", CORRUPT]
    assert got.collect()[0] == ("hi", 1, None)
    assert got.collect()[1] == (None, None, "{broken")
    # The blank line is skipped.
    assert got.collect()[2] == ("x", None, None)
    assert got.collect()[3][2] == '{"n":"no"}'
    assert got.count() == len(LINES) - 1


def test_round_trip(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("ü\n", None)], SCHEMA)
    back = parse_ndjson(to_ndjson(df), SCHEMA).drop(CORRUPT)
    assert rows(back) == rows(df)


def _run(spark, base, **options):
    stream = read_ndjson_stream(spark, f"{base}/in", SCHEMA, **options)
    ingest_ndjson(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_stream_splits_good_and_bad_and_never_repeats(spark, lines):
    base = scratch_path(spark, "stream")
    lines(*LINES[:2]).coalesce(1).write.text(f"{base}/in")
    first = _run(spark, base)
    assert rows(first.filter("kind = 'good'").select("message", "n")) == [("hi", 1)]
    assert rows(first.filter("kind = 'bad'").select(CORRUPT)) == [("{broken",)]
    # A restart from the checkpoint takes up the new file only.
    lines('{"message":"later","n":2}').coalesce(1).write.mode("append").text(f"{base}/in")
    again = _run(spark, base, max_files=1)
    assert rows(again.filter("kind = 'good'").select("message", "n")) == [("hi", 1), ("later", 2)]
    assert again.count() == 3


def test_stream_takes_several_folders_and_skips_blank_lines(spark, lines):
    base = scratch_path(spark, "stream")
    lines(LINES[0], "", "  \t").write.text(f"{base}/a")
    lines('{"message":"b","n":2}', "{broken").write.text(f"{base}/b")
    stream = read_ndjson_stream(spark, [f"{base}/a", f"{base}/b"], SCHEMA)
    ingest_ndjson(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{base}/out").select("message", "n", "kind")
    assert rows(out) == sorted([("hi", 1, "good"), ("b", 2, "good"), (None, None, "bad")], key=repr)


def test_stream_is_stateless(spark, lines):
    base = scratch_path(spark, "stream")
    lines(LINES[0]).write.text(f"{base}/in")
    stream = read_ndjson_stream(spark, f"{base}/in", SCHEMA)
    assert stream.isStreaming
    query = ingest_ndjson(stream, f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []


def test_socket_reader_is_a_stream_and_opens_nothing_yet(spark):
    try:
        stream = read_ndjson_socket(spark, "localhost", 6100, SCHEMA)
    except Exception as error:  # the source may be switched off
        pytest.skip(str(error))
    assert stream.isStreaming and stream.columns == ["message", "n", CORRUPT]
