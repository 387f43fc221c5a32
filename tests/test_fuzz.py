"""Random lines and frames against plain Python."""

import random
import re
from collections import Counter, defaultdict

from conftest import rows
from pyspark.sql import functions as F

from tallymark.plans import reviews as r
from tallymark.sources import parse_delimited, reject_lines

SCHEMA = "user_id string, movie_id string, rating double, ts string"
PICK = ["user_id", "movie_id", "rating"]
BLANKS = "".join(map(chr, range(33)))


def _lines(seed, n=1500):
    rng = random.Random(seed)
    parts = ["", " ", "a", "b c", "1", "4.5", "-2", " 3 ", "\t7", "x1", "1.2.3", "1e2"]
    out = []
    for _ in range(n):
        fields = [rng.choice(parts) for _ in range(rng.randint(0, 6))]
        out.append(rng.choice(["", " ", "\t"]) + ",".join(fields) + rng.choice(["", ",", ",,", " "]))
    return out


def _number(text):
    try:
        return float(text)
    except ValueError:
        return None


def _lenient(line):
    fields = line.split(",")
    return fields[:3] if len(fields) >= 3 else None


def _trimmed(line):
    fields = re.sub(",+$", "", line.strip(BLANKS)).split(",")
    return [f.strip(BLANKS) for f in fields[:3]] if len(fields) >= 3 else None


def test_parsing_matches_python(spark):
    data = _lines(1)
    df = spark.createDataFrame([(v,) for v in data], "value string")
    for trim, plain in ((False, _lenient), (True, _trimmed)):
        want, bad = [], []
        for line in data:
            fields = plain(line)
            value = _number(fields[2]) if fields else None
            if value is None:
                bad.append((line, "bad" if fields else "short"))
            else:
                want.append((fields[0], fields[1], value))
        got = parse_delimited(df, SCHEMA, pick=PICK, trim=trim)
        assert rows(got) == sorted(want, key=repr)
        assert rows(reject_lines(df, SCHEMA, pick=PICK, trim=trim)) == sorted(bad, key=repr)
        kept = parse_delimited(df, SCHEMA, pick=PICK, trim=trim, on_short="keep", on_bad="keep")
        assert kept.count() == len(data)


def test_words_match_python(spark):
    rng = random.Random(2)
    pool = ["Phòng", "sạch.", "(rất)", '"đẹp"', "a*b", "GIÁ;", "ok?!", "x,y", ".", "", "stop"]
    data = [
        (i if i % 9 else None, " ".join(rng.choices(pool, k=rng.randint(0, 12))),
         rng.choice(["P", "Q"]), rng.choice(["H", "R", None]),
         rng.choice(["positive", "negative", "neutral"]))
        for i in range(600)
    ]
    schema = "id int, review string, aspect string, category string, sentiment string"
    reviews = spark.createDataFrame(data, schema)
    counts = Counter()
    by_category = defaultdict(Counter)
    for id_, text, _, category, _ in data:
        clean = re.sub("[?!;,.]", "", text).lower()
        for word in filter(None, re.split('[ ",()*]', clean)):
            if word not in ("stop", "rất"):
                counts[word] += id_ is not None
                by_category[category][word] += id_ is not None
    table = spark.createDataFrame([("stop",), ("rất",), ("stop",)], "w string")
    for stop in (["stop", "rất"], table):
        assert dict(map(tuple, r.word_counts(reviews, stop).collect())) == dict(counts)
        got = r.top_words_by_category(reviews, stop, n=3)
        want = []
        for category, words in by_category.items():
            best = sorted(words.items(), key=lambda w: (-w[1], w[0].encode()))[:3]
            want += [(category, w, n) for w, n in best]
        assert rows(got) == sorted(want, key=repr)
        total = r.clean_words(reviews, stop).filter(F.col("id").isNotNull()).count()
        assert total == sum(counts.values())
