"""Whole jobs over small text files, down to the written lines."""

import json

import pytest

from tallymark.jobs import JOBS, main, run_job
from tallymark.session import scratch_path

MOVIES = ["m1, Alpha (1990), Drama|War", "m2, Beta, the Second (1991), Drama", "m3, Gamma (1992), Noir",
          "m4, Delta (1993), War|", "", "m5"]
RATINGS_1 = ["u1, m1, 4.0, 1577836800", "u2, m1, 4.5, 1577836800", "u3, m1, 2.0, 1546300800",
             "u4, m1, 3.0, 1577836800", "u1, m1, 1.5, x", "u9, m7, 5.0, 1577836800", "u1, m2"]
RATINGS_2 = ["u1, m2, 3.5, 1577836800", "u2, m2, 3.5, 1577836800", "u5, m4, 4.125, 1577836800"]
USERS = ["u1, M, 18, 1, 00001", "u2, f, 19, 2, 00002", "u3, X, 51, 1, 00003", "u4, F, 35, 3, 00004",
         "u5, M, old, 2, 00005"]
OCCUPATIONS = ["1,Programmer", "2,Doctor"]


def tight(values):
    return [v.replace(", ", ",") for v in values]


@pytest.fixture
def job(spark, tmp_path):
    def write(name, values):
        (tmp_path / name).write_bytes("\r\n".join(values).encode())
        return str(tmp_path / name)

    def run(name, inputs, **options):
        paths = {k: [write(f"{k}_{i}.txt", v) for i, v in enumerate(vs)] for k, vs in inputs.items()}
        out = scratch_path(spark, name)
        run_job(spark, name, paths, out, **options)
        return [r.value for r in spark.read.text(out).collect()]

    return run


RATED = {"ratings": [RATINGS_1, RATINGS_2], "movies": [MOVIES]}


def test_movie_averages(job):
    assert job("movie-averages", RATED) == [
        "Alpha (1990)\tAverage rating: 3.0 (Total ratings: 5)",
        "Beta\tAverage rating: 3.5 (Total ratings: 2)",
        "Delta (1993)\tAverage rating: 4.125 (Total ratings: 1)",
        "Unknown\tAverage rating: 5.0 (Total ratings: 1)",
    ]


def test_best_movie(job):
    assert job("best-movie", RATED) == [
        "Alpha (1990)\tis the highest rated movie with an average rating of 3.0 among movies with "
        "at least 5 ratings."
    ]
    assert job("best-movie", RATED, support=6) == []


def test_genre_averages(job):
    assert job("genre-averages", RATED) == [
        "Drama\tAvg: 3.00, Count: 5",
        "War\tAvg: 3.19, Count: 6",
        "the Second (1991)\tAvg: 3.50, Count: 2",
    ]


def test_gender_averages(job):
    assert job("gender-averages", {**RATED, "users": [USERS]}) == [
        "Alpha (1990)\t  Male: 2.75, Female: 3.75",
        "Beta\t  Male: 3.50, Female: 3.50",
        "Delta (1993)\t  Male: 4.13, Female: 0.00",
    ]


def test_age_band_averages(job):
    assert job("age-band-averages", {**RATED, "users": [USERS]}) == [
        "Alpha (1990)\t0-18: 2.75  18-35: 3.75  35-50: NA  50+: 2.00",
        "Beta\t0-18: 3.50  18-35: 3.50  35-50: NA  50+: NA",
        "Gamma (1992)\t0-18: NA  18-35: NA  35-50: NA  50+: NA",
        "Delta (1993)\t0-18: NA  18-35: NA  35-50: NA  50+: NA",
    ]


LENIENT = {"ratings": [tight(RATINGS_1), tight(RATINGS_2)], "users": [tight(USERS)]}
LENIENT_MOVIES = {**LENIENT, "movies": [tight(MOVIES)]}


def test_gender_report(job):
    assert job("gender-report", LENIENT_MOVIES) == [
        f"{'Alpha (1990)':<30} | Female  | 3.00",
        f"{'Alpha (1990)':<30} | Male    | 2.75",
        f"{'Alpha (1990)':<30} | Female  | 2.00",
        f"{'Alpha (1990)':<30} | Female  | 4.50",
        f"{'Beta':<30} | Male    | 3.50",
        f"{'Beta':<30} | Female  | 3.50",
        f"{'Delta (1993)':<30} | Male    | 4.12",
    ]


def test_age_band_report_cuts_at_the_row_limit(job):
    lines = job("age-band-report", LENIENT_MOVIES, rows=2)
    assert lines == [
        f"{'Alpha (1990)':<35} | {'18-30':<12} | 3.33",
        f"{'Alpha (1990)':<35} | {'31-40':<12} | 3.00",
    ]


def test_occupation_reports(job):
    assert job("occupation-report", LENIENT) == [
        f"{'1':<20} | 2.75        | 4",
        f"{'2':<20} | 4.04        | 3",
        f"{'3':<20} | 3.00        | 1",
    ]
    named = job("occupation-names", {**LENIENT, "occupations": [OCCUPATIONS]})
    assert named[0] == "1;2.75;4;Programmer"
    assert named[2] == "3;3.0;1;"


def test_year_report(job):
    assert job("year-report", {"ratings": LENIENT["ratings"]}) == [
        f"{'2019':<10} | 2.00        | 1",
        f"{'2020':<10} | 3.95        | 7",
    ]


STRICT_RATINGS = ["u1,m1,4.0,1", "u2,m1,4.5,2", "u1,m2,3.0,3"]
STRICT = {
    "ratings": [STRICT_RATINGS],
    "movies": [["m1,Alpha,Drama", "m2,Beta,War", "m3,Gamma,War"]],
}


def test_known_averages_blocks(job):
    text = "\n".join(sorted("\n".join(job("known-averages", STRICT)).replace("\n\t", "\x00").split("\n")))
    assert text.replace("\x00", "\n\t") == (
        "Alpha: \n\t+Avg, rating: 4.25\n\t+Times of rating: 2\n"
        "Beta: \n\t+Avg, rating: 3.0\n\t+Times of rating: 1"
    )


@pytest.mark.parametrize("bad", ["u1,m1,4.0", "u1,m1,4.0,1,extra", "u1,m1,x,1"])
def test_known_averages_fails_on_a_bad_line(job, bad):
    with pytest.raises(Exception):
        job("known-averages", {**STRICT, "ratings": [[*STRICT_RATINGS, bad]]})


def test_gender_blocks(job):
    users = [["u1,M,1,1,1", "u2,F,1,1,1"]]
    assert job("gender-blocks", {**STRICT, "users": users}) == [
        "Movie: Alpha ", "\t+Gender: Female", "\t+Avg rating: 4.50",
        "Movie: Alpha ", "\t+Gender: Male", "\t+Avg rating: 4.00",
        "Movie: Beta ", "\t+Gender: Male", "\t+Avg rating: 3.00",
    ]


REVIEWS = [
    "id;review;aspect;category;sentiment",
    "1;Phòng sạch, rất sạch!;CLEAN;ROOMS;positive",
    "2;Phòng ồn. Giá cao;PRICE;ROOMS;negative",
    "3;Giá tốt;PRICE;HOTEL;positive",
    "4;không rõ;PRICE;HOTEL;mixed",
    "5;bad; quoting;PRICE;HOTEL;positive",
    "6;giá ok;CLEAN;HOTEL;neutral",
    "x;giá giá;PRICE;HOTEL;positive",
]
STOP = ["rất", "rất", "không rõ"]
REVIEWED = {"reviews": [REVIEWS], "stopwords": [STOP]}


def test_review_jobs(job):
    assert sorted(job("clean-words", REVIEWED))[:3] == [
        "1;phòng;CLEAN;ROOMS;positive", "1;sạch;CLEAN;ROOMS;positive",
        "1;sạch;CLEAN;ROOMS;positive",
    ]
    # The review with no number as id counts nowhere.
    assert job("top-words", REVIEWED, top=3) == ["giá;3", "phòng;2", "sạch;2"]
    reviews = {"reviews": REVIEWED["reviews"]}
    assert sorted(job("comments-by-category", reviews)) == ["HOTEL;2", "ROOMS;2"]
    assert sorted(job("comments-by-aspect", reviews)) == ["CLEAN;2", "PRICE;2"]
    assert job("leading-aspect", reviews, sentiment="negative") == ["PRICE;negative;1"]
    assert job("leading-aspect", reviews, sentiment="positive") == ["CLEAN;positive;1"]
    assert sorted(job("category-words", REVIEWED, top=1)) == ["HOTEL;giá;2", "ROOMS;phòng;2"]
    assert sorted(job("category-words", REVIEWED, top=1, sentiment="positive")) == [
        "HOTEL;giá;1", "ROOMS;sạch;2",
    ]


ORDERS = ["Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp", "o1;c1;2024-01-05 10:00:00",
          "o2;c2;2024-03-01 00:00:00", "o3;c1;2023-12-31 23:59:59", "o4;;2024-03-09 00:00:00"]
ITEMS = ["Order_ID;Product_ID;Seller_ID;Price;Freight_Value", "o1;p1;s1;10.10;1.15",
         "o1;p1;s1;10.10;1.15", "o2;p2;s2;5.00;0.50", "o3;p1;s1;99.00;1.00", "o9;p9;s2;1.00;"]
SCORES = ["Order_ID;Review_Score", "o1;5", "o1;4", "o1;x", "o2;0", "o2;4.5", "o3;3"]
PRODUCTS = ["Product_ID;Product_Category_Name", "p1;toys", "p2;books"]
CUSTOMERS = ["Customer_Trx_ID;Customer_Country", "c1;VN", "c2;FR", "c3;DE"]


def test_shop_jobs(job):
    shop = dict(orders=[ORDERS], items=[ITEMS], reviews=[SCORES], products=[PRODUCTS],
                customers=[CUSTOMERS])

    def run(name, **options):
        return job(name, {k: shop[k] for k in JOBS[name].inputs}, **options)

    assert run("shop-totals") == ["total_orders;4", "total_customers;3", "total_sellers;2"]
    assert run("orders-by-country") == ["VN;2", "FR;1"]
    assert run("orders-by-month") == ["2023;12;1", "2024;3;2", "2024;1;1"]
    assert run("score-report") == [
        "Average Review Score: 4.00", "Score 3: 1 reviews", "Score 4: 1 reviews",
        "Score 5: 1 reviews",
    ]
    assert run("category-revenue", year=2024) == ["toys;22.5", "books;5.5"]
    assert run("product-stats") == ["p1;7;4.2", "p2;2;0.0"]
    assert run("seller-stats") == ["s1;122.5;2", "s2;5.5;2"]


def test_command_line(spark, tmp_path):
    (tmp_path / "r1.txt").write_text("u1,m1,4.0,1\nu2,m1,5.0,1")
    (tmp_path / "r2.txt").write_text("u1,m2,1.0,1")
    (tmp_path / "m.txt").write_text("m1,Alpha,War\nm2,Beta,War")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"message":"hi"}\n{bad\n')
    out = scratch_path(spark, "cli")
    ratings = [f"--input=ratings={tmp_path}/r{i}.txt" for i in (1, 2)]
    main(["best-movie", *ratings, f"--input=movies={tmp_path}/m.txt", f"--out={out}/best",
          "--support=2"])
    assert [r.value.split("\t")[0] for r in spark.read.text(f"{out}/best").collect()] == ["Alpha"]
    main(["ingest-json", f"--input=lines={tmp_path}/in", "--schema=message string",
          f"--checkpoint={out}/ck", f"--out={out}/rows"])
    assert spark.read.parquet(f"{out}/rows").filter("kind = 'good'").first().message == "hi"


def test_missing_input(spark):
    with pytest.raises(ValueError):
        run_job(spark, "best-movie", {"ratings": ["x"]}, "/nowhere")


def test_json_lines_are_plain_json(spark):
    from tallymark.streaming import to_ndjson

    df = spark.createDataFrame([("a\n\"b\"", 1)], "message string, n int")
    line = to_ndjson(df).first().value
    assert "\n" not in line and json.loads(line) == {"message": 'a\n"b"', "n": 1}


def test_shop_columns_are_found_by_name_and_summed_before_rounding(job):
    items = ["Extra;Price;Seller_ID;Freight_Value;Order_ID;Product_ID", *["x;0.333;s1;0;o1;p1"] * 9]
    assert job("seller-stats", {"items": [items]}) == ["s1;3.0;1"]
    assert job("seller-stats", {"items": [items]}, infer=True) == ["s1;3.0;1"]
    with pytest.raises(ValueError, match="Price"):
        job("seller-stats", {"items": [["Order_ID;Product_ID;Seller_ID;Freight_Value", "o;p;s;1"]]})


def test_unknown_and_incomplete_arguments_are_refused(job, capsys):
    with pytest.raises(ValueError, match="stopwords"):
        job("comments-by-aspect", REVIEWED)
    for wrong in (
        ["seller-stats", "--input", "item=x", "--out", "o"],
        ["seller-stats", "--input", "items", "--out", "o"],
        ["seller-stats", "--input", "items=x", "--out", "o", "--salts", "0"],
        ["ingest-json", "--input", "lines=x", "--out", "o", "--schema", "a int"],
        ["ingest-json", "--out", "o", "--schema", "a int", "--checkpoint", "c"],
    ):
        with pytest.raises(SystemExit):
            main(wrong)
    capsys.readouterr()


def test_reviews_without_an_id_are_dropped(job):
    reviews = [["id;review;aspect;category;sentiment", ";good room;A;C;positive", "2;good;A;C;positive"]]
    lines = job("clean-words", {"reviews": reviews, "stopwords": [["the"]]})
    assert lines == ["2;good;A;C;positive"]


def test_rejected_lines_can_be_written(job):
    ratings = ["u1,m1,4.0,0", "u1,m1", "u1,m1,x,0"]
    assert job("rating-rejects", {"ratings": [ratings]}) == ["u1,m1\tshort", "u1,m1,x,0\tbad"]
    assert job("user-rejects", {"users": [["u1,M,18,1,0", "u2,M,old,1,0"]]}) == ["u2,M,old,1,0\tbad"]


@pytest.mark.parametrize("name", ["gender-averages", "age-band-averages", "gender-report", "age-band-report"])
def test_isolating_hot_users_changes_no_line(job, name):
    inputs = LENIENT_MOVIES if name.endswith("report") else {**RATED, "users": [USERS]}
    assert job(name, inputs, isolate=True) == job(name, inputs)


def test_other_plans_of_words_and_revenue_change_no_line(job):
    assert sorted(job("clean-words", REVIEWED, filter_words=True)) == sorted(job("clean-words", REVIEWED))
    assert job("top-words", REVIEWED, top=3, cut=True) == job("top-words", REVIEWED, top=3)
    for sentiment in (None, "positive"):
        options = dict(top=2, sentiment=sentiment)
        cut = job("category-words", REVIEWED, cut=True, **options)
        assert sorted(cut) == sorted(job("category-words", REVIEWED, **options))
    shop = dict(orders=[ORDERS], items=[ITEMS], products=[PRODUCTS])
    for options in (dict(isolate=True), dict(salts=3)):
        assert job("category-revenue", shop, year=2024, **options) == ["toys;22.5", "books;5.5"]


def test_shop_files_may_order_their_columns_differently(job):
    swapped = ["Price;Seller_ID;Order_ID;Product_ID;Freight_Value", "7.00;s2;o5;p1;0.25"]
    assert job("seller-stats", {"items": [ITEMS, swapped]}) == ["s1;122.5;2", "s2;12.75;3"]
