import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import (
    attach_title,
    avg_by_lookup,
    avg_by_multivalue,
    avg_count_by,
    best_with_min_support,
    bucketed_avg_wide,
    conditional_avg,
    count_by,
    distinct_totals,
    drop_stopwords,
    fresh_rows,
    in_year,
    lookup,
    one_per_key,
    pair_stats,
    revenue_by,
    revenue_by_lookup,
    tokenize,
    top_n,
    top_n_per_group,
    valid_scores,
)


@pytest.fixture
def frame(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def test_avg_count_skips_null_values(frame):
    df = frame([("a", 1.0), ("a", None), ("a", 2.0), ("b", None)], "k string, v double")
    assert rows(avg_count_by(df, "k", "v")) == [("a", 1.5, 2), ("b", None, 0)]
    assert rows(avg_count_by(df, "k", "v", support=1)) == [("a", 1.5, 2)]
    assert rows(avg_count_by(df, [], "v")) == [(1.5, 2)]


def test_scaled_mean_equals_exact_mean(frame):
    rng = random.Random(1)
    data = [(rng.randint(0, 5), rng.randint(-9999, 9999) / 100) for _ in range(2000)]
    got = {r.k: (r.avg, r.n) for r in avg_count_by(frame(data, "k int, v double"), "k", "v", 2).collect()}
    cents = defaultdict(list)
    for k, v in data:
        cents[k].append(round(v * 100))
    assert got == {k: (sum(c) / 100 / len(c), len(c)) for k, c in cents.items()}


def test_empty_input(frame):
    df = frame([], "k string, v double")
    dim = frame([], "k string, t string")
    assert rows(avg_count_by(df, "k", "v")) == []
    assert rows(best_with_min_support(df, "k", "v")) == []
    assert rows(avg_by_multivalue(df, dim, "k", "t", "v")) == []
    assert rows(top_n_per_group(df, "k", 3, "v", [])) == []


def test_best_needs_support_and_breaks_ties_by_key(frame):
    data = [("z", 5.0)] * 4 + [("b", 4.0)] * 5 + [("a", 4.0)] * 6 + [("10", 3.0)] * 9
    df = frame(data, "k string, v double")
    assert rows(best_with_min_support(df, "k", "v", 5)) == [("a", 4.0, 6)]
    assert rows(best_with_min_support(df, "k", "v", 4)) == [("z", 5.0, 4)]
    assert rows(best_with_min_support(df, "k", "v", 10)) == []


def test_attach_title_left_does_not_fan_out(frame):
    agg = frame([("1", 2.0), ("2", 3.0), ("9", 4.0)], "k string, avg double")
    dim = frame([("1", "A"), ("1", "B"), ("2", "C"), ("3", "D")], "k string, title string")
    assert rows(attach_title(agg, dim, "k", "title")) == [
        ("1", 2.0, "B"), ("2", 3.0, "C"), ("9", 4.0, "Unknown"),
    ]
    assert rows(attach_title(agg, dim, "k", "title", "inner")) == [
        ("1", 2.0, "A"), ("1", 2.0, "B"), ("2", 3.0, "C"),
    ]


def test_lookup_unique_or_not(frame):
    fact = frame([("u", 1), ("v", 2), (None, 3)], "k string, x int")
    dim = frame([("u", "M"), ("u", "F"), ("w", "F")], "k string, g string")
    assert rows(lookup(fact, dim, "k", ["g"], "left", True)) == [
        ("u", 1, "M"), ("v", 2, None), (None, 3, None),
    ]
    assert len(rows(lookup(fact, dim, "k", ["g"], "inner"))) == 2


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("unique", [True, False])
def test_salted_lookup_is_the_plain_lookup(spark, frame, how, unique):
    data = [(("hot" if i % 3 else f"k{i % 7}") if i % 11 else None, i) for i in range(400)]
    fact = frame(data, "k string, x int").repartition(7, "x")
    dim = frame([("hot", "A"), ("hot", "B"), ("k0", "C"), ("k9", "D"), (None, "E")],
                "k string, g string")
    plain = lookup(fact, dim, "k", ["g"], how, unique)
    salted = lookup(fact, dim, "k", ["g"], how, unique, salts=5)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_one_per_key_and_fresh_rows(frame):
    dim = frame([("a", 1, "x"), ("a", 2, "b"), ("b", None, None)], "k string, n int, s string")
    picked = one_per_key(dim, "k")
    assert rows(picked) == [("a", 2, "b"), ("b", None, None)]
    assert rows(fresh_rows(picked)) == rows(picked)
    assert rows(one_per_key(dim.select("k"), "k")) == [("a",), ("b",)]


def test_avg_by_lookup_repeats_with_the_dimension(frame):
    fact = frame([("u", 1.0), ("u", 3.0), ("v", 5.0), ("x", 9.0)], "k string, v double")
    dim = frame([("u", "A"), ("u", "B"), ("v", "A")], "k string, c string")
    assert rows(avg_by_lookup(fact, dim, "k", "c", "v")) == [("A", 3.0, 3), ("B", 2.0, 2)]


def test_multivalue_counts_repeats_and_trims(frame):
    fact = frame([("1", 4.0), ("1", 2.0), ("2", 5.0)], "k string, v double")
    dim = frame(
        [("1", "Drama| War |Drama"), ("2", "War|"), ("2", "War"), ("3", "Noir")],
        "k string, genres string",
    )
    assert rows(avg_by_multivalue(fact, dim, "k", "genres", "v")) == [
        ("Drama", 3.0, 4), ("War", 4.0, 4),
    ]


def test_conditional_avg_ignores_case_and_others(frame):
    df = frame(
        [("1", "m", 4.0), ("1", "M", 2.0), ("1", "F", 5.0), ("2", "f", 1.0), ("3", "x", 9.0),
         ("3", None, 9.0)],
        "k string, g string, v double",
    )
    got = conditional_avg(df, "k", "g", {"male": "M", "female": "F"}, "v")
    assert got.columns == ["k", "male", "female"]
    assert rows(got) == [("1", 3.0, 5.0), ("2", None, 1.0)]


def test_bucketed_avg_keeps_every_dimension_row(frame):
    fact = frame(
        [("1", "a", 4.0), ("1", "a", 2.0), ("1", "b", 5.0), ("2", None, 1.0), ("9", "a", 3.0)],
        "k string, band string, v double",
    )
    dim = frame([("1", "T"), ("1", "S"), ("2", "U")], "k string, title string")
    got = bucketed_avg_wide(fact, dim, "k", "band", ["a", "b"], "v")
    assert rows(got) == [("1", "T", 3.0, 5.0), ("2", "U", None, None)]


def test_count_by_skips_null_ids(frame):
    df = frame([(1, "a"), (None, "a"), (None, "b")], "id int, k string")
    assert rows(count_by(df, "k", "id")) == [("a", 1), ("b", 0)]


def test_distinct_totals_and_null(frame):
    df = frame([(1,), (1,), (None,), (None,)], "k int")
    assert rows(distinct_totals(df, {"all": "k"})) == [("all", 2)]
    assert rows(distinct_totals(df, {"all": "k"}, count_null=False)) == [("all", 1)]


def test_top_n_ties_and_size(frame):
    df = frame([("b", 2), ("a", 2), ("c", 3), ("d", None)], "k string, n int")
    assert [r.k for r in top_n(df, 2, "n", ["k"]).collect()] == ["c", "a"]
    assert top_n(df, 9, "n", ["k"]).count() == 4


def test_top_n_per_group_matches_brute_force(frame):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randint(0, 9)}", f"w{i}", rng.randint(0, 20))
            for i in range(3000)]
    got = top_n_per_group(frame(data, "g string, w string, n int"), "g", 4, "n", ["w"])
    want = []
    for g in {d[0] for d in data}:
        want += sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1]))[:4]
    assert rows(got) == sorted(want, key=repr)


def test_tokenize(frame):
    df = frame(
        [(1, 'Phòng a.b, "RẤT" (đẹp)*sạch!'), (2, ""), (3, None), (4, " ?! "), (5, "a  b")],
        "id int, t string",
    )
    assert rows(tokenize(df, "t", ["id"])) == [
        (1, "ab"), (1, "phòng"), (1, "rất"), (1, "sạch"), (1, "đẹp"), (5, "a"), (5, "b"),
    ]
    other = frame([(1, "a\nb-c")], "id int, t string")
    assert rows(tokenize(other, "t", ["id"], strip="", delims="\n-")) == [
        (1, "a"), (1, "b"), (1, "c"),
    ]


def test_stopwords_as_list_or_table(frame):
    tokens = frame([(1, "a"), (2, "b"), (3, None), (4, "c d"), (5, "c")], "id int, word string")
    words = ["a", "a", "c d e", "b"]
    table = frame([(w,) for w in [*words, None]], "w string")
    want = [(3, None), (4, "c d"), (5, "c")]
    assert rows(drop_stopwords(tokens, words)) == want
    assert rows(drop_stopwords(tokens, table)) == want
    assert rows(drop_stopwords(tokens, [])) == rows(tokens)
    long = [*words, *(f"w{i}" for i in range(20_000))]
    assert rows(drop_stopwords(tokens, long)) == want
    assert rows(drop_stopwords(tokens, frame([(w,) for w in long], "w string"))) == want
    assert rows(drop_stopwords(tokens, table, salts=3)) == want
    with pytest.raises(ValueError):
        drop_stopwords(tokens, table, salts=0)


def test_valid_scores(frame):
    df = frame([("x",), ("4.7",), (" 5 ",), ("0",), ("6",), (None,), ("1",)], "s string")
    assert sorted(r.score for r in valid_scores(df, "s").collect()) == [1, 5]


def test_in_year_on_every_time_type(spark, frame):
    data = [("2023-12-31 23:59:59",), ("2024-01-01 00:00:00",), ("2024-12-31 23:59:59",),
            ("2025-01-01 00:00:00",), (None,)]
    df = frame(data, "s string")
    for dtype, want in (("timestamp", 2), ("timestamp_ntz", 2), ("date", 2)):
        typed = df.select(df.s.cast(dtype).alias("t"))
        assert in_year(typed, "t", 2024).count() == want


def test_revenue_ignores_incomplete_rows(frame):
    df = frame(
        [("a", "o1", 1.10, 0.05), ("a", "o1", 2.0, None), ("a", None, 0.1, 0.2), ("b", "o2", None, 1.0)],
        "k string, o string, p double, f double",
    )
    got = revenue_by(df, ["k"], "p", "f", distinct="o")
    assert rows(got) == [("a", 1.45, 1), ("b", None, 1)]
    assert rows(revenue_by(df, ["k"], "p", "f")) == [("a", 1.45), ("b", None)]


def test_revenue_is_rounded_after_the_sum(frame):
    for kind in ("double", "decimal(28,10)"):
        items = frame([("s", "o", "p", "0.333", "0.0")] * 9, "s string, o string, p string, v string, f string")
        items = items.withColumns({c: F.col(c).cast(kind) for c in ("v", "f")})
        assert rows(revenue_by(items, ["s"], "v", "f", distinct="o")) == [("s", 3.0, 1)]
        dim = frame([("p", "c")], "p string, c string")
        assert rows(revenue_by_lookup(items, dim, "p", "c", "v", "f")) == [("c", 3.0)]


def test_hundredths_refuse_further_decimals(frame):
    df = frame([("a", 1.25), ("a", None), ("b", 0.1)], "k string, v double")
    assert rows(avg_count_by(df, "k", "v", 2)) == [("a", 1.25, 1), ("b", 0.1, 1)]
    with pytest.raises(Exception, match="more than 2 decimals"):
        avg_count_by(df.union(frame([("b", 0.333)], "k string, v double")), "k", "v", 2).collect()
    with pytest.raises(ValueError, match="not a date"):
        in_year(df, "k", 2024)


@pytest.mark.parametrize("salts", [0, -1])
def test_salts_below_one_are_refused(frame, salts):
    df = frame([("a", 1)], "k string, g int")
    with pytest.raises(ValueError):
        lookup(df, df.withColumnRenamed("g", "h"), "k", ["h"], salts=salts)


def test_one_per_key_is_the_same_both_ways(frame):
    dim = frame([("a", 1, None), ("a", 1, "x"), ("a", None, "z"), ("b", None, None), (None, 2, "n")],
                "k string, g int, h string")
    assert rows(one_per_key(dim, "k")) == rows(one_per_key(dim, "k", many=True))


def test_totals_in_one_pass_count_null_once(frame):
    df = frame([("a",), (None,), (None,), ("b",)], "k string")
    assert rows(distinct_totals(df, {"d": "k"}, rows="n")) == [("d", 3), ("n", 4)]
    assert rows(distinct_totals(df, {"d": "k"}, count_null=False)) == [("d", 2)]
    assert rows(distinct_totals(df.filter("k = 'x'"), {"d": "k"}, rows="n")) == [("d", 0), ("n", 0)]


def test_revenue_by_lookup(frame):
    items = frame([("1", 1.0, 0.5), ("1", 2.0, 0.25), ("2", 3.0, 0.0), ("9", 9.0, 9.0)],
                  "k string, p double, f double")
    dim = frame([("1", "A"), ("2", "A"), ("3", "B")], "k string, c string")
    assert rows(revenue_by_lookup(items, dim, "k", "c", "p", "f")) == [("A", 6.75)]


def test_pair_stats_matches_the_join(frame):
    rng = random.Random(11)
    items = [(rng.choice("aaab") + str(rng.randint(0, 5)), rng.choice(["p", "q", "r", None]))
             for _ in range(300)]
    reviews = [(rng.choice("aaab") + str(rng.randint(0, 6)),
                rng.choice(["1", "5", "0", "6", "4.5", "x", None])) for _ in range(200)]
    got = pair_stats(frame(items, "o string, g string"), frame(reviews, "o string, s string"),
                     "o", "g", "s")
    pairs = defaultdict(list)
    for order, group in items:
        pairs[group] += [s for o, s in reviews if o == order]
    whole = {g: [int(s) for s in v if s and s.isdigit()] for g, v in pairs.items()}
    want = {g: (len(v) if g else 0, sum(whole[g]) / len(whole[g])) for g, v in pairs.items()}
    result = {r.g: (r.total_sold, r.average_score) for r in got.collect()}
    assert set(result) == set(want)
    for g, (sold, mean) in want.items():
        assert result[g][0] == sold
        assert abs(result[g][1] - mean) <= 0.005 + 1e-9


def test_pair_stats_two_items_three_reviews(frame):
    items = frame([("o", "p"), ("o", "p")], "o string, g string")
    reviews = frame([("o", "5"), ("o", "0"), ("o", "x")], "o string, s string")
    assert rows(pair_stats(items, reviews, "o", "g", "s")) == [("p", 6, 2.5)]
