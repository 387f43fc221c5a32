"""The methods themselves, on small made-up inputs."""

import random
import string
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import rows
from pyspark.sql import functions as F
from test_llm_queries import brute_classes, check_mix
from tokenizers import Tokenizer

from tallymark.llm import minhash_dedup as dedup
from tallymark.llm import secret_scan as secrets
from tallymark.llm.bit_sliced_search import best_rows, bit_slices, sum_slices
from tallymark.llm.components import components
from tallymark.llm.language_id import fit_temperature
from tallymark.llm.mixing import fair_mix
from tallymark.llm.packing import WordIds, best_fit_patterns, pack_histogram, slots
from tallymark.llm.prefix_tokens import (
    PrefixCounter,
    prefix_token_counts,
    prefix_within,
    tokens_of_prefix,
)
from tallymark.llm.pu_quality import best_bin_prior
from tallymark.llm.shingles import mixed, shingles, word_hashes
from tallymark.llm.warc_revisits import canonical_url, parse_records, resolve_revisits

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    *"abÉeént \n\t 0019,.!'s日本語ไ́\U0001F600İΣ▁_$", "<|startoftext|>", "<|endoftext|>", " the ", "tion",
    "\x1c", "\x85", "\xa0", "　", "\x0b", "Word", "'s", "|>", "<|", "  ", "<s>",
]


def noise(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_every_prefix_has_the_library_s_count():
    model, count = sentencepiece.SentencePieceProcessor(model_file=PIECES), PrefixCounter(PIECES)
    texts = noise(800, 1)
    for text, counts in zip(texts, count(pa.array(texts)), strict=True):
        assert counts.tolist() == [len(model.encode(text[:k])) for k in range(len(text) + 1)]


def test_stored_prefixes_answer_without_the_text(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = noise(40, 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = prefix_token_counts(docs, PIECES).drop("text")
    asked = table.select(
        "doc_id", tokens_of_prefix("prefixes", 7).alias("n"), prefix_within("prefixes", 5).alias("k")
    )
    for r in asked.collect():
        text = texts[r.doc_id]
        assert r.n == len(model.encode(text[:7]))
        fit = [k for k in range(len(text) + 1) if len(model.encode(text[:k])) <= 5]
        assert r.k == fit[-1]


def test_ids_word_by_word_are_those_of_the_whole_text():
    ids, library = WordIds(WORDS), Tokenizer.from_file(WORDS)
    texts = noise(5000, 3)
    encoded = library.encode_batch(texts, add_special_tokens=False)
    for got, want in zip(ids(pa.array(texts)), encoded, strict=True):
        assert got.tolist() == want.ids


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 4096])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([1, 30, 400]))]
    histogram = Counter({x: rng.choice([1, 7, 10_000]) for x in lengths})
    for plan in (pack_histogram(histogram, capacity), best_fit_patterns(dict(histogram), capacity)):
        held = Counter()
        for config, times in plan:
            assert times > 0 and sum(x * n for x, n in config.items()) <= capacity
            for x, n in config.items():
                held[x] += n * times
        assert held == histogram
    where = slots(pack_histogram(histogram, capacity))
    assert set(where) == set(histogram)
    assert pack_histogram({}) == []
    with pytest.raises(ValueError):
        pack_histogram({capacity + 1: 1}, capacity)


def test_plan_size_does_not_follow_the_counts():
    rng = random.Random(5)
    histogram = {rng.randint(20, 3000): rng.randint(50, 300) for _ in range(800)}
    plan = pack_histogram(histogram)
    many = pack_histogram({x: n * 10**6 for x, n in histogram.items()})
    least = sum(x * n for x, n in histogram.items()) / 4096
    assert sum(t for _, t in plan) <= 1.01 * least + 1
    assert sum(t for _, t in many) <= 1.005 * 10**6 * least + 1 and len(many) < 4 * 4096


def test_bit_slices_score_and_rank_exactly():
    rng = np.random.default_rng(4)
    values = rng.integers(-300, 300, (200, 7))
    values[50:60] = values[0]
    slices = bit_slices(values)
    for query in rng.integers(-256, 256, (20, 7)).tolist():
        sums, shift = sum_slices(slices, query)
        places = 1 << np.arange(len(sums), dtype=object)
        bits = np.unpackbits(sums.view(np.uint8), axis=1, bitorder="little")[:, :200]
        want = values @ np.array(query)
        assert ((places[:, None] * bits).sum(0) + shift == want).all()
        there = np.packbits(np.arange(256) < 200, bitorder="little").view(np.uint64)
        best = best_rows(sums, there, 5)
        assert sorted(best) == sorted(np.lexsort((np.arange(200), -want))[:5])


def test_word_hashes_follow_words_only():
    hashes, n = word_hashes(["a bc  d", "", " bc\t\na", "x" * 500])
    assert n.tolist() == [3, 0, 2, 1]
    assert hashes[1] == hashes[3] and hashes[0] == hashes[4] and len(set(hashes.tolist())) == 4
    r, _, times = shingles(["a b c d e f", "a b", "", "a a a a a a a"], 5)
    assert r.tolist() == [0, 0, 1, 3] and times.tolist() == [1, 1, 1, 3]


def test_signatures_agree_as_often_as_weighted_sets_are_similar():
    rng = np.random.default_rng(1)
    names = mixed(rng.integers(0, 2**62, 300, dtype=np.uint64))
    a = rng.integers(0, 4, 300) * 1.3
    b = np.where(rng.random(300) < 0.7, a, rng.integers(0, 6, 300))
    similarity = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    r = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
    h, w = np.concatenate([names[a > 0], names[b > 0]]), np.concatenate([a[a > 0], b[b > 0]])
    equal = []
    for seed in range(1, 41):
        s = dedup.signatures(r, h, w, 2, 128, seed)
        assert s.all()
        equal.append((s[0] == s[1]).mean())
    assert abs(np.mean(equal) - similarity) < 0.03


def variants(n, words, share, seed, with_base):
    """Copies of one text, each with its own random words replaced."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = [" ".join(base)] if with_base else []
    for i in range(n):
        own = [f"n{i}x{k}" if rng.random() < share else w for k, w in enumerate(base)]
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("with_base", [True, False])
def test_groups_whose_members_are_similar_only_to_some(spark, with_base, monkeypatch):
    """Copies that are alike through the base or some others alone: no link may be lost."""
    monkeypatch.setattr(dedup, "BLOCK", 16)
    texts = variants(60, 150, 0.022, 1, with_base) + variants(30, 40, 0.03, 2, False)
    texts += [f"only {i} of its kind with words {i * 7} and {i * 13}" for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = dict(rows(dedup.near_duplicate_classes(docs).select("doc_id", "class_id")))
    assert found == dict(enumerate(brute_classes(texts)))


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(100, 140)] + [(7, 7)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {x: find(x) for x in linked}


def test_random_keys_are_found_and_prose_is_not(spark):
    rng = random.Random(3)
    letters = string.ascii_letters + string.digits
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(2000)]
    keys = ["".join(rng.choice(letters) for _ in range(48)) for _ in range(40)]
    dull = ["".join(rng.choice("Ab1") for _ in range(48)) for _ in range(40)]
    docs = [(i, f"{p} {k}") for i, (p, k) in enumerate(zip(prose, keys, strict=False))]
    docs += [(100 + i, f"{p} {d}") for i, (p, d) in enumerate(zip(prose[50:], dull, strict=False))]
    docs += [(1000 + i, p) for i, p in enumerate(prose)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.scan_secrets(frame).collect()}
    assert sum(len(found[i]) for i in range(40)) >= 36
    assert all(s.kind == "random" and s.end - s.start == 48 for i in range(40) for s in found[i])
    assert not any(found[i] for i in found if i >= 100)
    clean = {r.doc_id: r.text for r in secrets.redacted_documents(frame).collect()}
    assert clean[1000] == prose[0] and all(keys[i] not in clean[i] for i in range(40) if found[i])


def test_failed_matches_take_their_text_with_them():
    text = 'secret: token: abcdefghijklmnop PassWord="short" api_key = abcdefghijkl'
    assert [str(s) for s in secrets.base_spans(text)] == ["assign:49:71"]


def test_custom_weights_caps_and_ties(spark):
    docs = [(i, "w " * (i % 9 + 1), f"s{i % 4}" if i % 4 else None) for i in range(400)]
    docs += [(1000, "same text", "s1")] * 3 + [(1001, "", "s9")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check_mix(fair_mix(frame).collect())
    weights = spark.createDataFrame([(None, 5.0), ("s1", 0.5), ("s2", 0.0)], "source string, weight double")
    found = fair_mix(frame, weights).collect()
    check_mix(found)
    assert all(r.taken == 0 for r in found if r.source in ("s2", "s9"))
    half = fair_mix(frame, budget=500).collect()
    assert 500 - 9 * 2 <= sum(r.taken for r in half) <= 500


URLS = {
    "HTTP://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1&Ref=y#frag": "example.com/a/b?a=1&b=2",
    "https://example.com": "example.com",
    "https://example.com/?": "example.com",
    " http://example.com:8080/A ": "example.com:8080/A",
    "example.com/x?sessionid=1": "example.com/x",
    None: None,
}


def test_canonical_urls(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert dict(frame.select("url", canonical_url("url")).collect()) == URLS


def warc(number, kind, date, url="http://e.com/x", status=200, digest=None, **fields):
    head = [f"WARC-Type: {kind}", f"warc-record-id: {number}", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {url}"] if url else []
    head += [f"WARC-Payload-Digest: {digest}"] if digest else []
    http = [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return "WARC/1.1\r\n" + "\r\n".join(head) + f"\r\n\r\nHTTP/1.1 {status} X\r\n" + "\r\n".join(http)


def test_revisits(spark):
    day = "2024-01-0{}T00:00:00Z".format
    records = [
        warc("r1", "response", day(1), ETag='"1"', Last_Modified="m1", Content_Type="text/html", Age="1"),
        warc("r2", "response", day(3), ETag='"2"', digest="d2"),
        warc("r3", "response", day(5), status=404, ETag='"3"'),
        warc("v1", "revisit", day(2), status=304, ETag='W/"1"', Age="9", Content_Type="no", X="y"),
        warc("v2", "revisit", day(3), status=304, Last_Modified="m1"),  # r2 is not earlier
        warc("v3", "revisit", day(4), status=304, ETag='"1"'),
        warc("v4", "revisit", day(6), status=304, digest="d2"),
        warc("v5", "revisit", day(6), status=304),
        warc("v6", "revisit", day(1), status=304, ETag='"1"'),
        warc("v7", "revisit", day(6), url=None, status=304, ETag='"1"'),
        warc("v4", "revisit", day(6), status=304, digest="d2"),
        warc("v8", "revisit", "never", status=304, ETag='"1"'),
        None, "", "rubbish", warc("x", "request", day(1)),
    ]
    frame = spark.createDataFrame([(r, "clash") for r in records], "record string, key string")
    parsed = parse_records(frame)
    assert parsed.count() == len(records)
    for seconds in (86_400, 3 * 86_400, 10**9):
        got = resolve_revisits(parsed, seconds).collect()
        assert sorted((r.record_id, r.verdict, r.response_id) for r in got) == sorted(
            [
                ("v1", "resolved", "r1"), ("v2", "resolved", "r1"), ("v3", "mismatch", "r2"),
                ("v4", "resolved", "r2"), ("v4", "resolved", "r2"), ("v5", "no_validator", "r2"),
                ("v6", "no_response", None), ("v7", "no_response", None), ("v8", "no_response", None),
            ],
            key=lambda x: (x[0], x[1]),
        )
        v1 = next(r for r in got if r.record_id == "v1")
        assert [tuple(f) for f in v1.fields] == [
            ("age", "9"), ("content-type", "text/html"), ("etag", 'W/"1"'), ("last-modified", "m1"),
            ("x", "y"),
        ]
    assert resolve_revisits(parsed.limit(0)).collect() == []


def test_a_hot_url_is_not_one_task(spark):
    """Within time buckets, no window holds all captures of the URL."""
    ids = spark.range(0, 20_000, numPartitions=8)
    captures = ids.select(
        F.col("id").cast("string").alias("record_id"),
        F.when(F.col("id") % 4 == 0, "response").otherwise("revisit").alias("kind"),
        F.lit("http://e.com/").alias("url"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 600).alias("date"),
        F.lit(200).alias("status"),
        F.lit("d").alias("digest"),
        F.expr("cast(array() as array<struct<name: string, value: string>>)").alias("fields"),
    )
    got = resolve_revisits(captures)
    assert got.groupBy("verdict").count().collect() == [("resolved", 15_000)]
    wrong = got.filter(F.col("response_id").cast("long") != F.floor((F.col("record_id").cast("long")) / 4) * 4)
    assert wrong.count() == 0


def test_calibration_and_prior():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(20_000, 3)) * 2
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert abs(fit_temperature(logits * 3, labels) - 3) < 0.2
    positive = rng.normal(3, 1, 4000)
    unlabelled = np.concatenate([rng.normal(3, 1, 6000), rng.normal(-3, 1, 4000)])
    assert abs(best_bin_prior(positive, unlabelled) - 0.6) < 0.03
