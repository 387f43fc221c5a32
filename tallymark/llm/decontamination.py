"""Benchmark passages in documents, by a positional inverted index in DataFrame operations alone.

`build_index` stores, for each word that the benchmark uses, the documents and positions where it
stands: each task writes a segment sorted by word, document and position. A window of benchmark
words is looked up from its rarest word on: the list of that word and the list of the next rarest, moved by
their distance, are intersected, and what is left is intersected with the lists of all other words
of the window. Windows that share their two rarest words share those steps.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import if_small, materialised

#: What separates words, after A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


class Index(NamedTuple):
    """docs (row, id, n_words), postings (term, row, pos) and terms (word, term, n: its postings)."""

    docs: DataFrame
    postings: DataFrame
    terms: DataFrame


def normalised(text: Column) -> Column:
    """The words of a text with one blank between them; empty if it is null or has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.btrim(F.regexp_replace(lower, BREAKS, " "), F.lit(" "))


def _words(clean: str) -> Column:
    return F.when(F.col(clean) == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def build_index(
    docs: DataFrame, words: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> Index:
    """Index of all whole texts, for the words of the first column of `words` or, without it, for all.

    Every row of docs is a document of its own, whatever its id; a null text has no words.
    """
    text = normalised(F.col(text_col).cast("string"))
    clean = docs.select(F.col(id_col).alias("id"), text.alias("clean"))
    blanks = F.octet_length("clean") - F.octet_length(F.replace("clean", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("clean") == "", 0).otherwise(blanks + 1).cast("long")
    numbered = clean.select(
        F.monotonically_increasing_id().alias("row"), "id", n_words.alias("n_words"), "clean"
    )
    numbered = materialised(numbered, "decon-docs")
    tokens = numbered.filter("clean != ''").select("row", F.posexplode(F.split("clean", " ")).alias("pos", "word"))
    if words is None:
        known = tokens.select("word").distinct()
    else:
        known = words.select(F.col(words.columns[0]).alias("word")).distinct()
    known = materialised(known.select("word", F.monotonically_increasing_id().alias("term")), "decon-words")
    found = tokens.join(if_small(known), "word").select("term", "row", "pos")
    postings = materialised(found.sortWithinPartitions("term", "row", "pos"), "decon-postings")
    n = postings.groupBy("term").agg(F.count("*").alias("n"))
    terms = known.join(n, "term", "left").select("word", "term", F.coalesce("n", F.lit(0)).alias("n"))
    return Index(numbered.select("row", "id", "n_words"), postings, materialised(terms, "decon-terms"))


class Items(NamedTuple):
    """texts (item, clean): distinct normalised texts that have words; ids (item, item_id): whose they are."""

    texts: DataFrame
    ids: DataFrame


def read_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Items:
    """Benchmark items by text. Ids become strings, a null id the empty one; rows of one id are one item."""
    clean = normalised(F.col(text_col).cast("string"))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = items.select(name.alias("item_id"), clean.alias("clean")).filter("clean != ''").distinct()
    texts = rows.select("clean").distinct()
    texts = materialised(texts.select(F.monotonically_increasing_id().alias("item"), "clean"), "decon-items")
    ids = materialised(rows.join(texts, "clean").select("item", "item_id"), "decon-ids")
    return Items(texts, ids)


def vocabulary(items: Items) -> DataFrame:
    """The words of all items."""
    return items.texts.select(F.explode(F.split("clean", " ")).alias("word")).distinct()


def _windows(items: Items, terms: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows all of whose words are indexed, as (window, len, by_rarity: (n, term, k) each),
    and (window, item)."""
    length = F.least(F.lit(size), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    cut = items.texts.select("item", _words("clean").alias("words")).select(
        "item", F.explode(F.transform(starts, lambda s: F.slice("words", s, length))).alias("words")
    )
    cut = materialised(cut.distinct(), "decon-cuts")
    distinct = cut.select("words").distinct()
    windows = materialised(
        distinct.select("words", F.monotonically_increasing_id().alias("window")), "decon-windows"
    )
    owners = cut.join(windows, "words").select("window", "item")
    parts = windows.select("window", F.posexplode("words").alias("k", "word"))
    held = parts.join(terms.filter("n > 0"), "word", "left")
    plan = held.groupBy("window").agg(
        F.count("*").cast("int").alias("len"),
        F.count("term").alias("held"),
        F.sort_array(F.collect_list(F.struct("n", "term", "k"))).alias("by_rarity"),
    )
    plan = plan.filter("held = len").drop("held")
    return materialised(plan, "decon-plan"), materialised(owners, "decon-owners")


def phrase_matches(index: Index, items: Items, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Every occurrence (row, start, len, window) of a window of an item, and (window, item).

    A window is `size` words in a row; an item of fewer words is one window.
    """
    plan, owners = _windows(items, index.terms, size)
    first, second = F.col("by_rarity")[0], F.get("by_rarity", F.lit(1))
    steps = plan.select(
        "window",
        "len",
        first["term"].alias("t1"),
        first["k"].alias("k1"),
        F.coalesce(second["term"], F.lit(-1)).alias("t2"),
        F.coalesce(second["k"] - first["k"], F.lit(0)).alias("apart"),
    )
    pairs = materialised(steps.select("t1", "t2", "apart").distinct(), "decon-pairs")
    rare = index.postings.withColumnRenamed("term", "t1").join(if_small(pairs), "t1")
    rare = rare.withColumn("at", F.col("pos") + F.col("apart"))
    seconds = materialised(pairs.select("t2").distinct(), "decon-seconds")
    other = index.postings.select(F.col("term").alias("t2"), "row", F.col("pos").alias("at"))
    other = other.join(if_small(seconds), "t2")
    met = rare.filter("t2 >= 0").join(other, ["row", "at", "t2"]).select("row", "pos", "t1", "t2", "apart")
    alone = rare.filter("t2 < 0").select("row", "pos", "t1", "t2", "apart")
    met = materialised(met.union(alone), "decon-met")

    possible = met.join(if_small(steps), ["t1", "t2", "apart"]).select(
        "row", (F.col("pos") - F.col("k1")).alias("start"), "len", "window"
    )
    done = possible.filter("len <= 2")
    rest = plan.filter("len > 2").select("window", F.explode(F.slice("by_rarity", F.lit(3), F.col("len"))).alias("x"))
    asked = possible.filter("len > 2").join(if_small(materialised(rest, "decon-rest")), "window")
    asked = asked.select("row", "start", "len", "window", (F.col("start") + F.col("x.k")).alias("at"), "x.term")
    rows = materialised(met.select("row").distinct(), "decon-rows")
    there = index.postings.join(if_small(rows), "row").withColumnRenamed("pos", "at")
    held = asked.join(there, ["row", "at", "term"]).groupBy("row", "start", "len", "window").count()
    whole = held.filter(F.col("count") == F.col("len") - 2).drop("count")
    return materialised(done.union(whole), "decon-matches"), owners


def proximity_matches(index: Index, items: Items, terms: int = 3, within: int = WINDOW) -> DataFrame:
    """(row, item, start, end): stretches of at most `within` words that hold the item's rarest words.

    Those are its `terms` rarest distinct words (by postings, equally rare ones by their bytes; all of them if they
    are fewer), in any order and place; an item with a word among them that has no posting has no
    match. A stretch is given for every position that ends one, from its first such word on.
    """
    words = items.texts.select("item", F.explode(F.array_distinct(F.split("clean", " "))).alias("word"))
    rarest = Window.partitionBy("item").orderBy("n", "word")
    counted = words.join(index.terms, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    chosen = counted.withColumn("place", F.row_number().over(rarest))
    chosen = chosen.filter(F.col("place") <= terms)
    of_item = Window.partitionBy("item")
    chosen = chosen.select(
        "item", "term", F.count("*").over(of_item).alias("wanted"), F.min("n").over(of_item).alias("least")
    )
    chosen = materialised(chosen.filter("least > 0").drop("least"), "decon-rarest")
    found = index.postings.join(if_small(chosen), "term")
    span = Window.partitionBy("row", "item").orderBy("pos").rangeBetween(1 - within, 0)
    near = found.select(
        "row",
        "item",
        F.min("pos").over(span).alias("start"),
        (F.col("pos") + 1).alias("end"),
        F.size(F.collect_set("term").over(span)).alias("held"),
        "wanted",
    )
    return near.filter("held = wanted").drop("held", "wanted")


def _covered(matches: DataFrame) -> DataFrame:
    """(row, n_hit): words inside any match."""
    spans = matches.select("row", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    from_ = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    new = spans.select("row", F.greatest(F.col("end") - from_, F.lit(0)).alias("new"))
    return new.groupBy("row").agg(F.sum("new").alias("n_hit"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """Per row of docs: id, n_words, n_hit, n_items, items (sorted ids), contaminated, n_near.

    n_hit counts the words inside any occurrence of a window, n_items the items with such an
    occurrence, n_near the items with a proximity match. Null and empty texts have no words;
    repeated rows each get their row; equal items share their matches; other columns are ignored.
    An empty benchmark leaves all documents clean, empty docs give no rows.
    """
    items = read_items(benchmark, item_id_col, item_text_col)
    index = build_index(docs, vocabulary(items), id_col, text_col)
    matches, owners = phrase_matches(index, items, size)
    owned = matches.select("row", "window").distinct().join(if_small(owners), "window")
    named = owned.select("row", "item").distinct().join(if_small(items.ids), "item")
    hits = named.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    hits = materialised(hits.join(_covered(matches), "row"), "decon-hits")
    near = proximity_matches(index, items).select("row", "item").distinct()
    near = near.join(if_small(items.ids), "item").groupBy("row").agg(F.countDistinct("item_id").alias("n_near"))
    out = index.docs.join(hits, "row", "left").join(materialised(near, "decon-near"), "row", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
