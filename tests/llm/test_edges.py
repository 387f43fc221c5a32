"""Every operator over awkward tables: nulls, empty and long texts, repeated rows, clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm.bit_sliced_search import top_k_inner_products
from tallymark.llm.language_id import fit_language_model, predict_language
from tallymark.llm.minhash_dedup import near_duplicate_classes, one_of_each
from tallymark.llm.mixing import fair_mix, mixed_documents
from tallymark.llm.packing import pack_documents
from tallymark.llm.prefix_tokens import prefix_token_counts
from tallymark.llm.pu_quality import fit_quality_model, score_quality
from tallymark.llm.quality_rules import kept_documents, quality_rules
from tallymark.llm.secret_scan import redacted_documents, scan_secrets

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "the quick brown fox " * 20_000 + "x" * 50_000
TEXT = "It was a bright cold day in April and the clocks were striking thirteen, said the man."
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (None, TEXT, "en", None, 7),
    (4, LONG, "en", "b", len(LONG)),
    (5, TEXT, "de", "b", None),
    (5, TEXT, "de", "b", None),
    (6, "one two", "fr", "c", 7),
    (6, "other text of the same id, with a few more words in it than the first one has", "fr", "c", 0),
    (7, "퟿\U0001f600 日本語 ไทย", "xx", "", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHES = (
    "id row rows node bands sketch words text_ n_tokens n_bytes prefixes score rank size taken mix mix_plan "
    "mix_times mix_turn kept_node kept_id spans kept broken h x key bucket component class_id length piece task"
).split()

OPERATORS = {
    "prefix": lambda d: prefix_token_counts(d, PIECES, budgets=(3,)),
    "secrets": scan_secrets,
    "redacted": redacted_documents,
    "language": lambda d: predict_language(d, fit_language_model(d)),
    "quality_pu": lambda d: score_quality(d, fit_quality_model(d, d.filter("doc_id > 3"))),
    "mix": fair_mix,
    "mixed": mixed_documents,
    "classes": near_duplicate_classes,
    "one_of_each": one_of_each,
    "pack": lambda d: pack_documents(d, WORDS),
    "rules": quality_rules,
    "kept": kept_documents,
}
ROW_FOR_ROW = {"prefix", "secrets", "redacted", "language", "quality_pu", "mix", "classes", "rules"}


def awkward(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, name):
    docs = awkward(spark)
    out = OPERATORS[name](docs)
    found = out.collect()
    if name in ROW_FOR_ROW:
        assert len(found) == len(ROWS)
        ids = sorted((r.doc_id for r in found), key=lambda x: (x is None, x))
        assert ids == sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))
    if name in ("redacted", "mixed", "one_of_each", "kept"):
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    # Run again: the same rows.
    key = str
    if name not in ("pack",):  # equal pieces may change places
        assert sorted(map(key, OPERATORS[name](docs).collect())) == sorted(map(key, found))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](awkward(spark).limit(0)).collect() == []


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 0.0]), (4, [inf, 1.0]),
        (5, [1.0, 2.0, 3.0]), (6, []), (7, [-0.5, 0.25]), (8, [1.0, 2.0]), (9, [1.0, 2.0]), (None, [5.0]),
        (50, [1e30, -1e30]),
    ]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = vectors.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    got = top_k_inner_products(vectors, F.col("vec_id") % 50 == 0, k=5).collect()
    mine = [(r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0]
    five = 256 * 256 + 512 * 512
    assert sorted(mine) == [(1, 5, five), (2, 8, five), (3, 9, five), (4, 6, 0), (5, 7, 0)]
    assert {r.query_id for r in got} == {0, 50}
    # Beyond 64 bits scores are cut.
    far = {r.vec_id: r.score for r in got if r.query_id == 50}
    assert far[0] == -(2**63) and far[6] == 0
    assert top_k_inner_products(vectors.limit(0), F.lit(True)).collect() == []


def test_pipeline_over_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() >= 1
    docs = awkward(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
