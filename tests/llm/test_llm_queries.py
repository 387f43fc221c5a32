"""The registered queries against their SQL, and against brute force where SQL cannot say it."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from check_oracle import compare, connect
from conftest import rows
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tallymark.llm.mixing import fair_mix
from tallymark.llm.oracle import ORACLE

SMALL, PLAIN = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("folder", [SMALL, PLAIN])
def test_query_matches_sql(spark, name, folder):
    assert compare(queries()[name](spark, folder), connect(folder), ORACLE[name]) == ""


def test_token_counts(spark):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    found = {r.doc_id: r for r in queries()["op1_prefix_token_counts"](spark, SMALL).collect()}
    docs = documents(spark, SMALL).collect()
    assert len(found) == len(docs)
    for doc in docs:
        text = doc.text or ""
        n = len(model.encode(text))
        got = found[doc.doc_id]
        assert (got.n_bytes, got.n_tokens, got.over_limit) == (len(text.encode()), n, n > 4096)
        assert len(model.encode(text[: got.chars_within_limit])) <= 4096


BASE = (
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def base_secrets(text):
    spans = []
    for place, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                spans.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(spans)


def test_secrets(spark):
    found = {r.doc_id: r for r in queries()["op3_secret_scan"](spark, PLAIN).collect()}
    docs = documents(spark, PLAIN).collect()
    assert len(found) == len(docs)
    n = 0
    for doc in docs:
        want = base_secrets(doc.text or "")
        got = found[doc.doc_id]
        kinds = Counter(x[3] for x in want)
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(kinds[k] for k, _ in BASE)
        text = ",".join(x[2] for x in want)
        assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [x for x in got.spans.split(",") if x and not x.startswith("random")] == [x[2] for x in want]
        n += len(want)
    assert n > 20


def test_language_is_found_in_held_out_documents(spark):
    found = {r.doc_id: r for r in queries()["op4_language_id"](spark, PLAIN).collect()}
    right, scores = [], []
    for doc in documents(spark, PLAIN).collect():
        got = found[doc.doc_id]
        assert got.held_out == (zlib.crc32(str(doc.doc_id).encode()) % 4 == 2)
        assert 0 <= got.score <= 1
        if got.held_out:
            right.append(got.lang_pred == doc.lang)
            scores.append(got.score)
    assert len(right) > 200 and np.mean(right) >= 0.97
    assert abs(np.mean(scores) - np.mean(right)) < 0.05  # calibrated


def test_quality_is_ranked_in_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries()["op5_pu_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    scores = {0: [], 1: []}
    for label in labels:
        got = found.get(label.doc_id)
        if got is not None and got.held_out:
            assert got.predicted == int(got.score >= 0.5)
            assert zlib.crc32(str(label.doc_id).encode()) % 3 == 1
            scores[label.quality].append(got.score)
    good, bad = np.array(scores[1]), np.array(scores[0])
    assert min(len(good), len(bad)) > 30
    area = np.mean(good[:, None] > bad[None, :]) + 0.5 * np.mean(good[:, None] == bad[None, :])
    assert area >= 0.98
    assert np.mean(good >= 0.5) >= 0.97 and np.mean(bad < 0.5) >= 0.85


def check_mix(found, most=3):
    """found: rows with source, size, source_size, target, taken."""
    by_source = defaultdict(list)
    for r in found:
        assert r.size * most >= r.taken >= 0 and (not r.size or r.taken % r.size == 0)
        by_source[r.source].append(r)
    total = sum(r.size for r in found)
    assert sum(r.taken for r in found) <= total
    for docs in by_source.values():
        size, target = docs[0].source_size, docs[0].target
        assert size == sum(r.size for r in docs) and target <= most * size + 1e-6
        assert abs(sum(r.taken for r in docs) - target) <= 2 * max(r.size for r in docs)
    assert abs(sum(d[0].target for d in by_source.values()) - total) < 1e-3 * max(total, 1)


def test_mix_comes_near_its_targets(spark):
    check_mix(fair_mix(documents(spark, PLAIN)).collect())


def brute_classes(texts):
    """Least index of the class of each text, by all pairs that share a shingle."""
    sets = []
    for text in texts:
        words = (text or "").split()
        grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        sets.append(Counter(grams))
    root, where, first = list(range(len(texts))), defaultdict(list), {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, grams in enumerate(sets):
        near = {first.setdefault(texts[i] or "", i)}
        for g in grams:
            near.update(where[g])
            where[g].append(i)
        for j in near:
            same = (texts[i] or "") == (texts[j] or "")
            shared = sum((grams & sets[j]).values())
            if same or shared >= 0.8 * sum((grams | sets[j]).values()):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_duplicates(spark):
    docs = sorted(documents(spark, PLAIN).collect(), key=lambda r: r.doc_id)
    roots = brute_classes([d.text for d in docs])
    want = {d.doc_id: docs[root].doc_id for d, root in zip(docs, roots, strict=True)}
    found = queries()["op8_dart_minhash_classes"](spark, PLAIN).collect()
    assert {r.doc_id: r.class_id for r in found} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in found)


def check_packed(found, texts):
    """found: rows of pieces; texts: (doc_id, text), a row as often as it is there."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    encoded = tokenizer.encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    for (doc_id, _), e in zip(texts, encoded, strict=True):
        ids = np.array([*e.ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    return len(sequences), -(-sum(r.length for r in found) // 4096)


def test_packing(spark):
    found = queries()["op9_pack_sequences"](spark, PLAIN).collect()
    used, least = check_packed(found, rows(documents(spark, PLAIN).select("doc_id", "text")))
    assert used <= 1.01 * least + 1


def test_pipeline_stage_by_stage(spark):
    """Each stage's result against a plain computation on that stage's input."""
    docs, found = documents(spark, SMALL), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SMALL)
        found[name] = (before.collect(), docs.collect())
    columns = documents(spark, SMALL).columns

    before, after = found["quality_rules"]
    con = connect(SMALL)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op10_quality_rules']}) WHERE kept").fetchall()}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept)

    before, after = found["minhash_dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = brute_classes([r.text for r in before])
    assert Counter(after) == Counter(before[i] for i in set(roots))

    before, after = found["secret_scan"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    was = {r.doc_id: r.text for r in before}
    for r in after:
        assert not base_secrets(r.text) and r.n_chars == len(r.text)
        assert r.text == was[r.doc_id] or "[SECRET]" in r.text

    before, after = found["fair_mix"]
    frame = spark.createDataFrame(before, docs_schema(spark))
    plan = {r.doc_id: r for r in fair_mix(frame).collect()}
    check_mix(list(plan.values()))
    assert Counter(after) == Counter({r: plan[r.doc_id].times for r in before if plan[r.doc_id].times})
    assert list(after[0].asDict()) == columns

    before, after = found["pack_sequences"]
    check_packed(after, [(r.doc_id, r.text) for r in before])

    whole = queries()["pipeline"](spark, SMALL)
    names = [c for c in whole.columns if c not in ("sequence_id", "offset")]
    assert Counter(whole.select(names).collect()) == Counter(docs.select(names).collect())


def docs_schema(spark):
    return documents(spark, SMALL).schema


def test_every_query_is_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(ORACLE) <= set(queries())


def test_native_queries_have_no_python(spark):
    for name in ("op6_fair_mix", "op10_quality_rules", "op12_benchmark_decontamination"):
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
