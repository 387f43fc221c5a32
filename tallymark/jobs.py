"""The queries as jobs over files: `spark-submit run_job.py JOB --input name=path ... --out path`.

A job reads text or CSV inputs (globs and any file system Spark knows), runs one query, and writes
report lines or delimited rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from typing import NamedTuple

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from tallymark.plans import movies as m
from tallymark.plans import reports
from tallymark.plans import reviews as r
from tallymark.plans import shop as s
from tallymark.sources import (
    read_csv,
    read_csv_columns,
    reject_lines,
    write_delimited,
    write_text,
)
from tallymark.streaming import ingest_ndjson, read_ndjson_stream

Inputs = dict[str, list[str]]


class Job(NamedTuple):
    inputs: tuple[str, ...]
    run: Callable[[SparkSession, Inputs, argparse.Namespace], DataFrame]
    write: Callable[[DataFrame, str], None]


def _ratings(spark, paths, reading, with_ts=False):
    return m.load_ratings(spark, paths["ratings"], reading, with_ts)


def _movies(spark, paths, reading, with_genres=False):
    return m.load_movies(spark, paths["movies"], reading, with_genres)


def _users(spark, paths, reading, attr):
    return m.load_users(spark, paths["users"], reading, attr)


def _movie_averages(spark, p, args):
    means = m.movie_averages(_ratings(spark, p, "trimmed"), _movies(spark, p, "trimmed"))
    return reports.movie_average_lines(means)


def _best_movie(spark, p, args):
    ratings, titles = _ratings(spark, p, "trimmed"), _movies(spark, p, "trimmed")
    best = m.best_movie(ratings, titles, args.support)
    return reports.best_movie_lines(best, args.support)


def _genre_averages(spark, p, args):
    means = m.genre_averages(_ratings(spark, p, "trimmed"), _movies(spark, p, "trimmed", True))
    return reports.genre_lines(means)


def _gender_averages(spark, p, args):
    users = _users(spark, p, "trimmed", "gender")
    ratings, titles = _ratings(spark, p, "trimmed"), _movies(spark, p, "trimmed")
    return reports.gender_wide_lines(
        m.gender_averages_wide(ratings, titles, users, salts=args.salts, isolate=args.isolate)
    )


def _age_band_averages(spark, p, args):
    users = _users(spark, p, "trimmed", "age")
    ratings, titles = _ratings(spark, p, "trimmed"), _movies(spark, p, "trimmed")
    return reports.age_band_wide_lines(
        m.age_band_averages_wide(ratings, titles, users, salts=args.salts, isolate=args.isolate)
    )


def _known_averages(spark, p, args):
    means = m.movie_averages_known(_ratings(spark, p, "exact"), _movies(spark, p, "exact"))
    return reports.movie_average_blocks(means)


def _gender_blocks(spark, p, args):
    users = _users(spark, p, "strict", "gender")
    ratings, titles = _ratings(spark, p, "strict"), _movies(spark, p, "strict")
    means = m.gender_averages_long(ratings, titles, users, salts=args.salts, isolate=args.isolate)
    first = m.first_rows(means, ["movie_id", "gender"], args.rows)
    return reports.gender_blocks(m.gender_names(first))


def _gender_report(spark, p, args):
    users = _users(spark, p, "lenient", "gender")
    ratings, titles = _ratings(spark, p, "lenient"), _movies(spark, p, "lenient")
    means = m.gender_averages_long(ratings, titles, users, salts=args.salts, isolate=args.isolate)
    first = m.first_rows(means, ["movie_id", "gender"], args.rows)
    return reports.gender_lines(m.gender_names(first))


def _age_band_report(spark, p, args):
    users = _users(spark, p, "lenient", "age")
    ratings, titles = _ratings(spark, p, "lenient"), _movies(spark, p, "lenient")
    means = m.age_band_averages_long(ratings, titles, users, salts=args.salts, isolate=args.isolate)
    return reports.age_band_lines(m.first_rows(means, ["movie_id", "band"], args.rows))


def _occupation_report(spark, p, args):
    users = _users(spark, p, "lenient", "occupation")
    return reports.occupation_lines(m.occupation_averages(_ratings(spark, p, "lenient"), users))


def _occupation_names(spark, p, args):
    users = _users(spark, p, "lenient", "occupation")
    codes = m.load_occupations(spark, p["occupations"])
    return m.occupation_averages_named(_ratings(spark, p, "lenient"), users, codes)


def _year_report(spark, p, args):
    return reports.year_lines(m.year_averages(_ratings(spark, p, "lenient", True)))


def _rejects(name, schema, pick):
    """The lines of an input that the lenient reports leave out, and why."""

    def run(spark, p, args):
        return reject_lines(spark.read.text(p[name]), schema, pick=pick, trim=False)

    return Job((name,), run, write_text)


def _reviews(spark, p):
    return r.load_reviews(spark, p["reviews"]), r.load_stopwords(spark, p["stopwords"])


def _clean_words(spark, p, args):
    words = r.clean_words(*_reviews(spark, p), salts=args.salts, filtered=args.filter_words)
    return words.select("id", "word", "aspect", "category", "sentiment")


def _top_words(spark, p, args):
    return r.top_words(*_reviews(spark, p), args.top, cut=args.cut)


def _comments(attr):
    return lambda spark, p, args: r.comments_by(r.load_reviews(spark, p["reviews"]), attr)


def _leading_aspect(spark, p, args):
    return r.leading_aspect(r.load_reviews(spark, p["reviews"]), args.sentiment)


def _category_words(spark, p, args):
    return r.top_words_by_category(*_reviews(spark, p), args.sentiment, args.top, cut=args.cut)


def _csv(spark, p, args, *names):
    """The named inputs, with the declared columns or, if asked for, inferred types."""
    if args.infer:
        return [read_csv(spark, p[n]) for n in names]
    return [read_csv_columns(spark, p[n], s.SCHEMAS[n]) for n in names]


def _shop(fn, *names):
    return Job(names, lambda spark, p, args: fn(*_csv(spark, p, args, *names)), write_delimited)


def _category_revenue(spark, p, args):
    inputs = _csv(spark, p, args, "orders", "items", "products")
    return s.category_revenue(*inputs, args.year, args.salts, args.isolate)


def _product_stats(spark, p, args):
    return s.product_stats(*_csv(spark, p, args, "items", "reviews"), args.salts)


def _score_report(spark, p, args):
    return reports.score_lines(s.score_summary(*_csv(spark, p, args, "reviews")))


RATED = ("ratings", "movies")
REVIEWED = ("reviews", "stopwords")
JOBS: dict[str, Job] = {
    "movie-averages": Job(RATED, _movie_averages, write_text),
    "best-movie": Job(RATED, _best_movie, write_text),
    "genre-averages": Job(RATED, _genre_averages, write_text),
    "gender-averages": Job((*RATED, "users"), _gender_averages, write_text),
    "age-band-averages": Job((*RATED, "users"), _age_band_averages, write_text),
    "known-averages": Job(RATED, _known_averages, write_text),
    "gender-blocks": Job((*RATED, "users"), _gender_blocks, write_text),
    "gender-report": Job((*RATED, "users"), _gender_report, write_text),
    "age-band-report": Job((*RATED, "users"), _age_band_report, write_text),
    "occupation-report": Job(("ratings", "users"), _occupation_report, write_text),
    "occupation-names": Job(
        ("ratings", "users", "occupations"), _occupation_names, write_delimited
    ),
    "year-report": Job(("ratings",), _year_report, write_text),
    "rating-rejects": _rejects("ratings", m.RATINGS, ["user_id", "movie_id", "rating"]),
    "movie-rejects": _rejects("movies", m.MOVIES, ["movie_id", "title"]),
    "user-rejects": _rejects("users", m.USERS, ["user_id", "age"]),
    "clean-words": Job(REVIEWED, _clean_words, write_delimited),
    "top-words": Job(REVIEWED, _top_words, write_delimited),
    "comments-by-category": Job(("reviews",), _comments("category"), write_delimited),
    "comments-by-aspect": Job(("reviews",), _comments("aspect"), write_delimited),
    "leading-aspect": Job(("reviews",), _leading_aspect, write_delimited),
    "category-words": Job(REVIEWED, _category_words, write_delimited),
    "shop-totals": _shop(s.totals, "orders", "items"),
    "orders-by-country": _shop(s.orders_by_country, "orders", "customers"),
    "orders-by-month": _shop(s.orders_by_month, "orders"),
    "score-report": Job(("reviews",), _score_report, write_text),
    "category-revenue": Job(("orders", "items", "products"), _category_revenue, write_delimited),
    "product-stats": Job(("items", "reviews"), _product_stats, write_delimited),
    "seller-stats": _shop(s.seller_stats, "items"),
}


def _check_inputs(name: str, wanted: tuple[str, ...], paths: Inputs) -> None:
    missing = [i for i in wanted if i not in paths]
    if missing:
        raise ValueError(f"{name} needs the inputs {missing}")
    unknown = sorted(set(paths) - set(wanted))
    if unknown:
        raise ValueError(f"{name} has no inputs {unknown}, only {list(wanted)}")


def _positive(text: str) -> int:
    number = int(text)
    if number < 1:
        raise argparse.ArgumentTypeError("must be at least 1")
    return number


def run_job(spark: SparkSession, name: str, paths: Inputs, out: str, **options) -> None:
    """Run one job; `paths` maps each of its inputs to its files."""
    job = JOBS[name]
    _check_inputs(name, job.inputs, paths)
    defaults = {"support": 5, "rows": 20, "top": 5, "sentiment": None, "year": 2024, "salts": 1}
    flags = dict.fromkeys(("infer", "isolate", "filter_words", "cut"), False)
    args = argparse.Namespace(**{**defaults, **flags, **options})
    job.write(job.run(spark, paths, args), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "ingest-json"])
    parser.add_argument("--input", action="append", default=[], metavar="NAME=PATH")
    parser.add_argument("--out", required=True)
    parser.add_argument("--support", type=int, default=5)
    parser.add_argument("--rows", type=int, default=20)
    parser.add_argument("--top", type=int, default=5)
    parser.add_argument("--year", type=int, default=2024)
    parser.add_argument(
        "--salts", type=_positive, default=1, help="split hot join keys this often"
    )
    parser.add_argument(
        "--isolate", action="store_true", help="find hot join keys and split those (one more pass)"
    )
    parser.add_argument(
        "--filter-words",
        action="store_true",
        help="drop stopwords by a broadcast filter instead of shuffling all words (one more pass)",
    )
    parser.add_argument(
        "--cut", action="store_true", help="count only words that may be among the top (one more pass)"
    )
    parser.add_argument(
        "--infer", action="store_true", help="infer the types of CSV inputs (one more pass)"
    )
    parser.add_argument("--sentiment", choices=r.SENTIMENTS)
    parser.add_argument("--schema", help="DDL of the JSON objects")
    parser.add_argument("--checkpoint", help="checkpoint folder of the stream")
    args = vars(parser.parse_args(argv))
    paths: Inputs = {}
    for item in args.pop("input"):
        name, _, path = item.partition("=")
        if not path:
            parser.error(f"--input {item} is not NAME=PATH")
        paths.setdefault(name, []).append(path)
    job, out = args.pop("job"), args.pop("out")
    schema, checkpoint = args.pop("schema"), args.pop("checkpoint")
    ingest = job == "ingest-json"
    if ingest and not (schema and checkpoint):
        parser.error("ingest-json needs --schema and --checkpoint")
    try:
        _check_inputs(job, ("lines",) if ingest else JOBS[job].inputs, paths)
    except ValueError as error:
        parser.error(str(error))
    # What spark-submit was given stands; the web page is off unless asked for.
    conf = SparkConf().setIfMissing("spark.ui.enabled", "false")
    conf.setIfMissing("spark.app.name", f"tallymark {job}")
    spark = SparkSession.builder.config(conf=conf).getOrCreate()
    if ingest:
        stream = read_ndjson_stream(spark, paths["lines"], schema)
        ingest_ndjson(stream, out, checkpoint).awaitTermination()
    else:
        run_job(spark, job, paths, out, **args)
