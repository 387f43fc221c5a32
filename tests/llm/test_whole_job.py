"""Work that was once left out: each test fails where only a part of the job is done."""

import random
import string

import numpy as np
import pytest

from tallymark.llm import secret_scan as secrets
from tallymark.llm.quality_rules import quality_rules


def prose(n, words, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return [" ".join(rng.choices(vocabulary, k=words)) for _ in range(n)]


def counted(texts):
    out = np.zeros((len(secrets.ENCODINGS) * len(secrets.LENGTHS), secrets.BINS), np.int64)
    secrets.prose_windows(texts, out)
    return out


def all_windows(texts):
    """Every window one by one, by the battery itself."""
    out = np.zeros((len(secrets.ENCODINGS) * len(secrets.LENGTHS), secrets.BINS), np.int64)
    for text in texts:
        codes = np.array([ord(c) for c in "".join(text.split())], np.int64)
        for k, n in enumerate(secrets.LENGTHS.tolist()):
            if len(codes) < n:
                continue
            starts = sorted({*range(0, len(codes) - n + 1, n), len(codes) - n})
            windows = np.array([codes[at : at + n] for at in starts])
            for code, alphabet in enumerate(secrets.ENCODINGS.values()):
                bins = secrets._bin(secrets.evidence(windows % len(alphabet), len(alphabet)))
                out[code * len(secrets.LENGTHS) + k] += np.bincount(bins, minlength=secrets.BINS)
    return out


@pytest.mark.parametrize("piece", [5760, secrets._PIECE])
def test_every_class_sees_every_text(monkeypatch, piece):
    monkeypatch.setattr(secrets, "_PIECE", piece)
    texts = [*prose(6, 150, 1), "", "a" * 40, "короткий текст " * 3, "日本語" * 50, *prose(1, 3000, 2)]
    texts += ["x" * n for n in (15, 16, 17, 127, 128)] + [prose(1, 5000, 3)[0].replace(" ", "")[:n] for n in (5760, 5800, 11520 + 127)]
    found = counted(texts)
    assert (found == all_windows(texts)).all()
    assert (found == sum(counted([t]) for t in texts)).all()  # rows add up, in any partitions
    some = np.arange(len(found)) % 7 == 3
    out = np.zeros_like(found)
    secrets.prose_windows(texts, out, some)
    assert (out == found * some[:, None]).all()


def test_random_keys_are_found_in_a_small_table_of_many_partitions(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(44)) for _ in range(12)]
    docs = [(i, f"{p} {k}") for i, (p, k) in enumerate(zip(prose(12, 400, 5), keys, strict=True))]
    docs += [(100 + i, p) for i, p in enumerate(prose(110, 400, 6))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {n: {r.doc_id: r.spans for r in secrets.scan_secrets(frame.repartition(n)).collect()} for n in (2, 16)}
    assert found[2] == found[16]
    assert sum(len(found[2][i]) for i in range(12)) >= 10
    assert not any(found[2][100 + i] for i in range(110))


# Sentences of languages outside the stop-word lists, each with its own frequent words.
LANGUAGES = {
    "ru": "не и в на что он с как это по мы они к но из у за то же от ты его так".split(),
    "el": "και το να του η της με που την από για είναι δεν στο θα τα".split(),
    "ar": "في من على إلى أن هذا التي مع لا ما هو كان بين عن".split(),
    "hi": "के में की है और से का को पर यह इस भी नहीं कर".split(),
    "ko": "이 그 수 것 등 및 더 또 한 두".split(),
    "fi": "ja ei oli se että joka mutta hän ovat kuin niin myös".split(),
    "id": "yang dan ini itu dengan untuk tidak dari dalam akan pada".split(),
    "pl": "nie się na jest że jak ale co tak już ich może".split(),
}
ENDINGS = {"ru": "абвгдежзик", "el": "αβγδεζηθικ", "ar": "ابتثجحخدذر", "hi": "कखगघचछजटडत", "ko": "가나다라마바사아자차"}


def natural(lang, n, seed=1):
    """n words, a third of them frequent ones by Zipf's law; lines of twelve words."""
    rng = random.Random(seed)
    frequent, letters = LANGUAGES[lang], ENDINGS.get(lang, "kmnprstvlj")
    weights = [1 / (i + 1) for i in range(len(frequent))]
    words = [
        rng.choices(frequent, weights)[0] if rng.random() < 0.33 else "".join(rng.choices(letters, k=rng.randint(4, 9)))
        for _ in range(n)
    ]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


def unspaced(letters, n, seed=2):
    rng = random.Random(seed)
    return "\n".join(" ".join("".join(rng.choices(letters, k=rng.randint(45, 90))) for _ in range(3)) + "。" for _ in range(n))


def test_clean_documents_of_all_languages_are_kept(spark):
    rng = random.Random(3)
    clean = {lang: natural(lang, 400) for lang in LANGUAGES}
    clean |= {"zh": unspaced("的一是不了人我在有他这中大来上国", 30), "ja": unspaced("のにはをたがでて日本語人々ー、カタ", 30)}
    clean |= {"th": unspaced("กขคงจชดตนบปพมยรลวสหอะาิีึืุูเแโ", 90), "mixed": natural("ru", 300) + " the of and " * 3}
    clean["en"] = " ".join(rng.choice(["the", "of", *(f"w{k}x" for k in range(300))]) + f" n{k}" for k in range(150)) + " the a of in"
    junk = {"no_stop_words": " ".join("".join(rng.choices("bcdfgklmprstz", k=6)) for _ in range(400))}
    junk["long_words"] = " ".join("".join(rng.choices("bcdfgklmprstz", k=60)) for _ in range(30))
    frame = spark.createDataFrame([*clean.items(), *junk.items()], "doc_id string, text string")
    found = {r.doc_id: r for r in quality_rules(frame).collect()}
    assert {x: found[x].broken for x in clean if not found[x].kept} == {}
    assert {x: found[x].broken for x in junk} == {x: [x] for x in junk}
