"""What the contracts say of odd letters, other tokenizers, repeated vectors, other scripts and long words."""

import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from check_oracle import compare, connect
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tallymark.llm.language_id import fit_language_model, predict_language
from tallymark.llm.oracle import ORACLE
from tallymark.llm.packing import WordIds, cuts_words
from tallymark.llm.words import Remembered

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_texts_without_letters_have_no_language(spark):
    docs = [(i, f"some plain english words number {i}", "en") for i in range(30)]
    docs += [(100, "½ ² ¾", "en"), (101, "① ②", "en"), (102, "Ⅷ", "en"), (103, "7_7 …", "en"), (104, "ª", "en"), (105, "ж 5", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in predict_language(df, fit_language_model(df)).collect()}
    assert {k: v for k, v in found.items() if k >= 100} == {
        100: "und", 101: "und", 102: "und", 103: "und", 104: "en", 105: "en"
    }


def other_tokenizers(tmp_path):
    plain = json.load(open(WORDS, encoding="utf-8"))
    cased = json.loads(json.dumps(plain))
    cased["normalizer"]["normalizers"].pop()
    joined = json.loads(json.dumps(plain))
    joined["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\S+|\s+"
    own = json.loads(json.dumps(plain))
    own["added_tokens"].append({**own["added_tokens"][0], "id": 49408, "content": "b b", "special": False})
    bare = json.loads(json.dumps(plain))
    bare["normalizer"] = bare["pre_tokenizer"] = None
    for name, config in {"cased": cased, "joined": joined, "own": own, "bare": bare}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(config), encoding="utf-8")
        yield str(path)
    yield public_tokenizers.path("byte_bpe_50k.json")


def test_other_tokenizers_get_the_ids_of_the_library(tmp_path):
    assert cuts_words(Tokenizer.from_file(WORDS).to_str())
    texts = ["A a A", "a b b, B b", "", None, "It's  1,234.\nEnd. end", "é É 日本 ", "<|endoftext|> x"]
    for path in [WORDS, *other_tokenizers(tmp_path)]:
        ids, library = WordIds(path), Tokenizer.from_file(path)
        assert ids.by_words == (path == WORDS)
        found = [list(x) for x in ids(pa.array(texts))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_memory_of_words_is_bounded_in_bytes():
    asked = []

    def compute(words):
        asked.extend(words)
        return [w[::-1] for w in words]

    known = Remembered(compute, 1000, most_bytes=1 << 20)
    rng = random.Random(1)
    for _ in range(300):
        words = [bytes([rng.randrange(256)]) * rng.choice([3, 50, 400, 100_000]) for _ in range(50)]
        assert known(words) == [w[::-1] for w in words]
        held = [*known.new.items(), *known.old.items()]
        assert sum(len(a) + len(b) for a, b in held) < 2 * (1 << 20) + 50 * 1024
    assert max(len(w) for w in [*known.new, *known.old]) == 400
    known([b"x" * 100_000] * 2)
    assert Counter(asked)[b"x" * 100_000] >= 2


def test_repeated_vectors_are_searched_as_in_the_sql(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 6)], 0) for i in range(200)]
    rows += [rows[0], rows[0], rows[3], (3, rows[4][1], 1), (250, None, 0), (300, [None] * 6, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.coalesce(1).write.parquet(f"{tmp_path}/all")
    next((tmp_path / "all").glob("part-*")).rename(tmp_path / "embeddings.parquet")
    name = "op7_bit_sliced_top_k"
    assert compare(queries()[name](spark, str(tmp_path)), connect(str(tmp_path)), ORACLE[name]) == ""


def texts_in_many_scripts():
    rng = random.Random(8)
    words = {
        "ru": "и в не на я он что тот быть с а весь это как она по но они к у ты из мы за вы так же от".split(),
        "el": "και το να του της στη με για από που είναι ένα θα δεν τα οι σε ή αλλά αν".split(),
        "fi": "ja on ei se että hän oli joka mutta kun niin myös tai jos vain ovat sen".split(),
        "la": [f"verbum{i}" for i in range(400)],
        "en": "the of and to in is that it for on with as".split(),
    }
    texts = [" ".join(rng.choices(w, k=n)) + "." for w in words.values() for n in (8, 60, 250, 600)]
    texts += ["ภาษาไทยเป็นภาษาที่ไม่มีช่องว่าง" * 8 + " " + " ".join(["ยาวมากจริงๆ" * 6] * 12)]
    texts += ["。".join("中文文本没有空格而且句子很长很长" * 5 for _ in range(12)), "日本語の文章です。" * 90]
    texts += [" ".join("かな交じり文" * 12 for _ in range(20)), " ".join("x" * 60 for _ in range(20))]
    texts += [" ".join(f"Ⅷ{i} ½ ª{i} λ{i}" for i in range(120)), " ".join([f"iunk{i}" for i in range(300)] + ["sum"] * 9)]
    texts += [" ".join(rng.choices(words["la"] + words["ru"] * 9, k=500)), " ".join(rng.choices(words["la"] * 3 + words["ru"], k=500))]
    return texts + [t.upper() for t in texts] + [None, "", "ﬁ ﬂ " * 200]


def test_quality_rules_in_many_scripts_match_the_sql(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts_in_many_scripts())]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/all")
    next((tmp_path / "all").glob("part-*")).rename(tmp_path / "documents.parquet")
    name = "op10_quality_rules"
    found = queries()[name](spark, str(tmp_path))
    assert compare(found, connect(str(tmp_path)), ORACLE[name]) == ""
    kept = Counter(r.kept for r in found.collect())
    assert min(kept.values()) >= 8


def test_scripts_without_spaces_lie_in_their_range(spark):
    from tallymark.llm.quality_rules import UNSPACED, UNSPACED_RANGE

    codes = spark.range(1, 0x110000).filter("id < 55296 or id > 57343")
    utf32 = "decode(unhex(lpad(hex(id), 8, '0')), 'utf-32')"
    signs = codes.selectExpr("id", f"{utf32} as sign")
    assert signs.filter("id = 945 and sign = 'α'").count() == 1
    inside = signs.filter(f"sign rlike r'{UNSPACED}'")
    assert inside.count() > 90_000 and inside.filter(f"not sign rlike r'{UNSPACED_RANGE}'").count() == 0
