"""CSV files whose headers differ: columns by name, refusals, packed and empty files."""

import gzip

import pytest
from conftest import rows

from tallymark.sources import csv_layouts, read_csv, read_csv_columns

KINDS = "order_id string, product_id string, price decimal(10,2)"


def files(folder, **texts):
    for name, text in texts.items():
        path = folder / name.replace("_", ".", 1)
        data = text.encode()
        path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(folder)


def test_columns_are_found_in_every_file(spark, tmp_path):
    path = files(
        tmp_path,
        a_csv="Order_ID;Product_ID;Price\no1;p1;1.5\no2;p2;\n",
        b_csv="Product_ID;Order_ID;Price\np3;o3;3\n",
        c_csv='note;PRICE;"order_id";Product_ID;more\nx;4.25;o4;"p;4";y\n',
        d_csv="Price;Product_ID;Order_ID\r\n5;p5;o5\r\n",
        e_csv="\n  \nProduct_ID;Order_ID;Price\np6;o6;6\n",
    )
    got = read_csv_columns(spark, path, KINDS)
    assert got.columns == ["order_id", "product_id", "price"]
    assert [(a, b, None if c is None else float(c)) for a, b, c in rows(got)] == [
        ("o1", "p1", 1.5), ("o2", "p2", None), ("o3", "p3", 3), ("o4", "p;4", 4.25), ("o5", "p5", 5), ("o6", "p6", 6)
    ]
    assert len(csv_layouts(spark, path)) == 4
    assert rows(read_csv_columns(spark, f"{path}/[ab].csv", KINDS).select("order_id")) == [("o1",), ("o2",), ("o3",)]
    assert got.count() == 6


def test_a_missing_or_repeated_column_is_refused_by_name(spark, tmp_path):
    path = files(tmp_path, a_csv="order_id;product_id;price\n1;2;3\n", b_csv="order_id;price\n1;3\n")
    with pytest.raises(ValueError, match=r"\['product_id'\].*b\.csv"):
        read_csv_columns(spark, path, KINDS)
    path = files(tmp_path, b_csv="order_id;product_id;Price;price\n1;2;3;4\n")
    with pytest.raises(ValueError, match=r"\['price'\].*b\.csv"):
        read_csv_columns(spark, path, KINDS)
    assert read_csv_columns(spark, path, "order_id string, product_id string").count() == 2


def test_packed_empty_marked_and_odd_file_names(spark, tmp_path):
    path = files(
        tmp_path,
        a_csv="",
        b_gz="product_id;order_id;price\np1;o1;1\n",
        c_csv="﻿order_id;product_id;price\no2;p2;2\n",
        d_csv="order_id;product_id;price\n",
    )
    (tmp_path / "e [x]{y} 100%.csv").write_text("price;order_id;product_id\n3;o3;p3\n")
    got = rows(read_csv_columns(spark, path, "order_id string, product_id string"))
    assert got == [("o1", "p1"), ("o2", "p2"), ("o3", "p3")]


def test_only_empty_files_give_no_rows(spark, tmp_path):
    got = read_csv_columns(spark, files(tmp_path, a_csv="", b_csv="\n\n"), KINDS)
    assert got.count() == 0 and got.columns == ["order_id", "product_id", "price"]


def test_folders_named_like_columns(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"day={day}").mkdir()
        files(tmp_path / f"day={day}", a_csv=f"order_id;price\no{day};{day}\n")
    assert rows(read_csv_columns(spark, str(tmp_path), "price int, order_id string")) == [(1, "o1"), (2, "o2")]


def test_a_value_that_does_not_parse_fails(spark, tmp_path):
    path = files(tmp_path, a_csv="order_id;price\no1;x\n", b_csv="price;order_id\n1;o2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv_columns(spark, path, "price int").collect()


def test_read_csv_refuses_files_with_another_header(spark, tmp_path):
    path = files(tmp_path, a_csv="order_id;product_id\no1;p1\n", b_csv="product_id;order_id\np2;o2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, schema="order_id string, product_id string").select("order_id").collect()
    assert rows(read_csv(spark, f"{path}/a.csv", schema="order_id string, product_id string")) == [("o1", "p1")]
    same = files(tmp_path, b_csv="ORDER_ID;PRODUCT_ID\no2;p2\n")
    assert read_csv(spark, same).count() == 2
    assert read_csv(spark, f"{path}/a.csv", header=False).count() == 2


def test_no_data_is_read_before_the_rows_are_asked_for(spark, tmp_path):
    path = files(tmp_path, a_csv="order_id;price\n" + "o;1\n" * 10, b_csv="price;order_id\n1;o\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = read_csv_columns(spark, path, "price int")
        assert not tracker.getJobIdsForGroup("headers")
        assert df.count() == 11
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
