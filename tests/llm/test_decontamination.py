"""The positional index against brute force: random texts of few words, awkward rows, both join plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallymark.llm import common, decontamination
from tallymark.llm.decontamination import build_index, decontaminate, proximity_matches, read_items, vocabulary

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, size=10):
    """(id, n_words, n_hit, items) of each document, sorted."""
    cuts = {}
    for key, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            cuts.setdefault(tuple(w[i : i + n]), set()).add("" if key is None else str(key))
    out = []
    for key, text in docs:
        w, hit, of = words(text), set(), set()
        for n in {len(c) for c in cuts}:
            for i in range(len(w) - n + 1):
                if owners := cuts.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    of |= owners
        out.append((key, len(w), len(hit), sorted(of)))
    return sorted(out, key=repr)


def near(text, item, counts, terms=3, within=10):
    rare = sorted(set(words(item)), key=lambda x: (counts.get(x, 0), x.encode()))[:terms]
    w = words(text)
    return bool(rare) and any(set(rare) <= set(w[i : i + within]) for i in range(len(w)))


def check(spark, docs, items, **options):
    df = decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    found = df.collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr)
    assert got == brute(docs, items, **options)
    assert all(r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in found)
    return found


def random_case(seed):
    rng = random.Random(seed)
    letters = ["ab", "Cd", "é", "x9", "the", "of", "日本", "zz"]

    def text(n):
        return "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 3, 9, 10, 11, 14, 30]))) for i in range(25)]
    items += [items[7], (100, items[8][1]), (None, text(3)), (101, None), (7, "of of of")]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 300]))) for i in range(40)]
    docs += [(50 + i, text(20) + items[i][1] + text(20) + items[i][1].upper()) for i in range(25)]
    docs += [docs[3], docs[3], (None, items[10][1]), (70, None), (71, " ,;\n")]
    return docs, items


@pytest.mark.parametrize(("seed", "small"), [(1, 32 << 20), (2, -1)], ids=["broadcast", "shuffled"])
def test_random_texts(spark, monkeypatch, seed, small):
    monkeypatch.setattr(common, "SMALL", small)
    docs, items = random_case(seed)
    found = check(spark, docs, items)
    counts = {}
    for _, text in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    want = sorted(
        (repr(key), len({"" if k is None else str(k) for k, item in items if near(text, item, counts)}))
        for key, text in docs
    )
    assert sorted((repr(r.doc_id), r.n_near) for r in found) == want


def test_other_window_sizes(spark):
    docs, items = random_case(3)
    check(spark, docs, items, size=1)
    check(spark, docs, items, size=4)


def test_long_texts_and_repeated_passages(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    items = [(1, passage), (2, passage), (3, "w58 w59 alone")]
    docs = [(1, "filler " * 50_000 + passage + " filler" * 50_000), (2, (passage + " ") * 30), (3, passage[:-5])]
    docs += [(4, "W0 w1 w2 w3 w4 w5 w6 w7 w8 x w9"), (5, "w0-w1-w2-w3-w4-w5-w6-w7-w8-w9")] * 3
    found = {r.doc_id: r for r in check(spark, docs, items)}
    assert found[1].n_hit == 60 and found[2].n_hit == 1800 and found[4].n_hit == 0 and found[5].n_hit == 10


def test_empty_tables(spark):
    docs = [(1, "some words of a document"), (2, None)]
    assert check(spark, [], [(1, "some words")]) == []
    assert [r.n_items for r in check(spark, docs, [])] == [0, 0]
    assert [r.n_near for r in check(spark, docs, [(1, None), (2, "  ")])] == [0, 0]


def test_clashing_names(spark):
    names = "row id clean term pos word n n_words item items window start len at count t1 t2 k n_hit held x".split()
    docs, items = random_case(4)
    extra = [F.lit("x").alias(c) for c in names]
    left = spark.createDataFrame(docs, DOCS).select("*", *extra)
    right = spark.createDataFrame(items, ITEMS).select("*", *extra)
    found = decontaminate(left, right).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr)
    assert got == brute(docs, items)


def test_index_of_all_words_and_spans(spark):
    docs = spark.createDataFrame([(1, "a b c x x x a y y c z b"), (2, "c b a"), (3, "a b")], DOCS)
    items = read_items(spark.createDataFrame([(9, "a, b... c!"), (8, "nowhere a")], ITEMS))
    index = build_index(docs)
    assert index.postings.count() == 17 and index.terms.count() == 6
    assert sum(r.n for r in index.terms.collect()) == 17
    places = {r.row: r.id for r in index.docs.collect()}
    found = proximity_matches(index, items, terms=3, within=4)
    assert sorted((places[r.row], r.start, r.end) for r in found.collect()) == [(1, 0, 3), (2, 0, 3)]
    wider = proximity_matches(index, items, terms=3, within=6)
    spans = sorted((places[r.row], r.start, r.end) for r in wider.collect())
    assert spans == [(1, 0, 3), (1, 1, 7), (1, 6, 12), (2, 0, 3)]
    assert vocabulary(items).count() == 4


def test_no_python_and_no_pairs_in_the_plan(spark):
    docs, items = random_case(5)
    df = decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert decontamination.WINDOW == 10
