"""The registered queries of this subpackage: name -> (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm.bit_sliced_search import top_k_inner_products
from tallymark.llm.collocations import collocations
from tallymark.llm.common import table
from tallymark.llm.decontamination import decontaminate
from tallymark.llm.language_id import fit_language_model, held_out, predict_language
from tallymark.llm.minhash_dedup import near_duplicate_classes
from tallymark.llm.mixing import fair_mix
from tallymark.llm.packing import pack_documents
from tallymark.llm.prefix_tokens import prefix_token_counts
from tallymark.llm.pu_quality import fit_quality_model, score_quality
from tallymark.llm.quality_rules import quality_rules
from tallymark.llm.secret_scan import KINDS, scan_secrets
from tallymark.llm.warc_revisits import crawl_log, parse_records, resolve_revisits
from tallymark.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The budget that op1 asks about.
TOKEN_LIMIT = 4096


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_prefix_token_counts(spark, d):
    model = public_tokenizers.path("piece_bpe_32k.model")
    counts = prefix_token_counts(
        table(spark, d, "documents"), model, budgets=(TOKEN_LIMIT,), keep_prefixes=False
    )
    return counts.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col(f"fits_{TOKEN_LIMIT}").alias("chars_within_limit"),
    )


@query
def op3_secret_scan(spark, d):
    found = scan_secrets(table(spark, d, "documents"))

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op4_language_id(spark, d):
    docs = table(spark, d, "documents")
    held = held_out("doc_id", 4, 2)
    model = fit_language_model(docs.filter(~held))
    return predict_language(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op5_pu_quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held = held_out("doc_id", 3, 1)
    good = labels.filter((F.col("quality") == 1) & ~held)
    model = fit_quality_model(docs.filter(~held), good)
    return score_quality(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op6_fair_mix(spark, d):
    mix = fair_mix(table(spark, d, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_bit_sliced_top_k(spark, d):
    vectors = table(spark, d, "embeddings")
    return top_k_inner_products(vectors, F.col("vec_id") % 50 == 0)


@query
def op8_dart_minhash_classes(spark, d):
    return near_duplicate_classes(table(spark, d, "documents"))


@query
def op9_pack_sequences(spark, d):
    return pack_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_quality_rules(spark, d):
    return quality_rules(table(spark, d, "documents")).drop("broken")


@query
def op11_phrase_collocations(spark, d):
    return collocations(table(spark, d, "documents"))


@query
def op12_benchmark_decontamination(spark, d):
    found = decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


@query
def op13_whitening(spark, d):
    rows = whiten(table(spark, d, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op2_warc_revisits(spark, d):
    captures = parse_records(crawl_log(table(spark, d, "pages")))
    found = resolve_revisits(captures)
    fields = F.transform("fields", lambda x: F.concat(x["name"], F.lit(": "), x["value"]))
    return found.select(
        F.split("record_id", "-")[0].try_cast("long").alias("page_id"),
        F.split("record_id", "-")[1].cast("int").alias("visit"),
        "canonical_url",
        "verdict",
        "response_id",
        "digest",
        F.array_join(fields, "\n").alias("headers"),
    )


@query
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)
