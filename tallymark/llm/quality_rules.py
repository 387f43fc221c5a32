"""Quality rules from a threshold table, compiled into one projection of built-in expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    *("a", "and", "as", "at", "be", "by", "for", "in", "is", "it", "of", "on", "that", "the", "to"),
    *("auf", "das", "der", "des", "die", "ein", "mit", "und", "von", "zu"),
    *("au", "de", "des", "du", "est", "et", "la", "le", "les", "un", "une", "que", "dans"),
    *("con", "del", "el", "en", "es", "las", "los", "por", "se", "su", "y"),
)
#: Letters (and their marks) of scripts that put no spaces between words, and their punctuation.
UNSPACED = (
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
    r"\p{IsTibetan}\p{IsYi}\p{IsJavanese}\p{IsBalinese}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\u3000-\u303F\u30FC\uFF00-\uFF65]"
)
#: Where all of UNSPACED lies: looked for first, as one range is much cheaper to test than many scripts.
UNSPACED_RANGE = r"[\u02EA\u02EB\u0E00-\u1BFF\u2E80-\uFFFF\x{10000}-\x{10FFFF}]"
#: A word of a text's own this frequent is taken for a stop word of a language that is not listed.
OWN_STOP_WORD = 0.015


class Rule(NamedTuple):
    """A document of at least `from_words` words fails if `metric` leaves [low, high].

    A rule with `where` applies only to documents for which that condition of `ratios` holds.
    """

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    where: str | None = None


#: The table of the method. Metrics are the names in `ratios`.
RULES = (
    Rule("short_words", "mean_word_chars", low=1.5, from_words=10),
    Rule("long_words", "mean_spaced_chars", high=40.0, from_words=10),
    Rule("symbols", "symbols_per_word", high=0.4, from_words=10),
    Rule("shouting", "shouts_per_word", high=0.4, from_words=10),
    Rule("no_stop_words", "stop_word_share", low=0.005, from_words=200, where="stop_words_known"),
    Rule("repeated_lines", "dup_line_share", high=0.5, from_words=10),
    Rule("bullet_lines", "bullet_line_share", high=0.9, from_words=10),
    Rule("ellipsis_lines", "ellipsis_line_share", high=0.5, from_words=10),
)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _without(text: str, chars: str) -> Column:
    return F.translate(F.col(text), chars, "")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs packed into a column `row`, and the counts of every text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_stop_words, n_shouts, n_bullet_lines, n_ellipsis_lines, n_unspaced, stop_words_known.

    n_unspaced is the number of characters of scripts without spaces between words. The stop words
    are known to fit a text if a twentieth of its words are among them, or if most of its letters are
    Latin and none of its own words is as frequent as a stop word of another language would be.

    Repeated windows are found by sorting their 64-bit hashes, and only for texts that have any.
    """
    words = F.split(F.btrim("text", F.lit(BLANKS)), f"[{SPACE}]+")
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    df = df.select("row", "text", words.alias("found"), lines.alias("lines"))
    # Each of these characters has three bytes or more.
    wide = (F.octet_length("text") >= F.length("text") + 2) & F.col("text").rlike(UNSPACED_RANGE)
    df = df.select(
        "row",
        "text",
        F.when(wide, F.regexp_count("text", F.lit(UNSPACED))).otherwise(0).cast("long").alias("n_unspaced"),
        F.when(F.col("found")[0] == "", F.expr("cast(array() as array<string>)"))
        .otherwise(F.col("found"))
        .alias("words"),
        F.length(_without("text", BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without("text", SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(f"[!?]{{2,}}([{SPACE}]|$)")).cast("long").alias("n_shouts"),
        F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(BLANKS)).rlike("^[-*•‣◦]")))
        .cast("long")
        .alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(BLANKS)).rlike(r"(\.\.\.|…)$")))
        .cast("long")
        .alias("n_ellipsis_lines"),
    )
    counted = [c for c in df.columns if c not in ("row", "text", "words")]
    stops = F.filter("words", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))
    df = df.select(
        "row",
        *counted,
        F.size("words").cast("long").alias("n_words"),
        F.size(stops).cast("long").alias("n_stop_words"),
        "text",
        "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    counted += ["n_words", "n_stop_words"]
    df = df.select("row", *counted, _stop_words_known().alias("stop_words_known"), "hashes")
    counted += ["stop_words_known"]
    last = F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0))
    at = [lambda i, k=k: F.get("hashes", i + k) for k in range(1, WINDOW)]
    windows = F.transform(
        F.slice("hashes", F.lit(1), last), lambda x, i: F.xxhash64(x, *(a(i) for a in at))
    )
    df = df.select("row", *counted, windows.alias("windows"))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    located = F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.select("row", *counted, F.when(repeats, F.sort_array(located)).alias("sorted"))
    again = F.filter(
        "sorted",
        lambda x, j: F.coalesce(F.get("sorted", j + 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("sorted", j - 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.select("row", *counted, F.sort_array(F.transform(again, lambda x: x["i"])).alias("starts"))
    # Each window adds what the one before it in the text has not covered.
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            s.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    repeat = F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    # Behind a generator of one row: filters on these columns do not repeat the work below.
    return df.select("row", F.inline(F.array(F.struct(*counted, repeat))))


def _stop_words_known() -> Column:
    """Over text, words, n_words and n_stop_words; costly only for texts with few stop words."""
    letters = F.regexp_count("text", F.lit(r"\p{L}"))
    latin = F.regexp_count("text", F.lit(r"[\p{L}&&\p{IsLatin}]"))
    # Runs of equal words, in order: (last word, length of its run, longest run).
    bare = F.transform("words", lambda w: F.regexp_replace(F.lower(w), r"^[^\p{L}\p{M}]+|[^\p{L}\p{M}]+$", ""))
    longest = F.aggregate(
        F.sort_array(F.filter(bare, lambda w: w != "")),
        F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("most")),
        lambda acc, w: _longer(w, F.when(w == acc["word"], acc["run"] + 1).otherwise(F.lit(1)), acc["most"]),
        lambda acc: acc["most"],
    )
    own = longest >= OWN_STOP_WORD * F.col("n_words")
    listed = F.col("n_stop_words") * 20 >= F.col("n_words")
    return F.when(listed, F.lit(True)).when(2 * latin < letters, F.lit(False)).otherwise(~own)


def _longer(word: Column, run: Column, most: Column) -> Column:
    return F.struct(word.alias("word"), run.alias("run"), F.greatest(most, run).alias("most"))


def ratios() -> dict[str, Column]:
    """The metrics that rules may name, over the columns of `measures`."""
    words, lines = F.col("n_words"), F.col("n_lines")
    return {
        "n_words": words.cast("double"),
        "mean_word_chars": _share(F.col("word_chars"), words),
        "mean_spaced_chars": _share(F.col("word_chars") - F.col("n_unspaced"), words),
        "symbols_per_word": _share(F.col("n_symbols"), words),
        "shouts_per_word": _share(F.col("n_shouts"), words),
        "stop_word_share": _share(F.col("n_stop_words"), words),
        "dup_line_share": _share(F.col("n_dup_lines"), lines),
        "bullet_line_share": _share(F.col("n_bullet_lines"), lines),
        "ellipsis_line_share": _share(F.col("n_ellipsis_lines"), lines),
        "repeat_word_share": _share(F.col("n_repeat_words"), words),
        "stop_words_known": F.col("stop_words_known"),
    }


def compiled(rules: tuple[Rule, ...]) -> list[Column]:
    """One boolean column a rule: true where a document breaks it."""
    known = ratios()
    columns = []
    for rule in rules:
        if rule.metric not in known:
            raise ValueError(f"rule {rule.name}: unknown metric {rule.metric}")
        broken = F.lit(False)
        if rule.low is not None:
            broken = broken | (known[rule.metric] < rule.low)
        if rule.high is not None:
            broken = broken | (known[rule.metric] > rule.high)
        if rule.where is not None:
            broken = broken & known[rule.where]
        columns.append(((F.col("n_words") >= rule.from_words) & broken).alias(rule.name))
    return columns


def _judged(docs: DataFrame, rules: tuple[Rule, ...], text_col: str) -> DataFrame:
    """`measures` with base_failed, broken and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.filter(
        F.array(*(F.when(c, F.lit(r.name)) for c, r in zip(compiled(rules), rules, strict=True))),
        lambda x: x.isNotNull(),
    )
    df = measures(docs, text_col).withColumn("base_failed", failed).withColumn("broken", broken)
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def quality_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and `broken`, the names of the rules that the text breaks.

    A null text has no words and fails the base (fewer than ten words), as an empty one does.
    Rows are judged one by one, so repeated rows get the same verdict. Columns other than id and
    text are neither read nor returned. No shuffle, no Python.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = _judged(slim, rules, "text")
    return judged.select(F.col("row.id").alias(id_col), *counted, "base_failed", "broken", "kept")


def kept_documents(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """The rows of docs that `quality_rules` keeps, with all their columns."""
    return _judged(docs, rules, text_col).filter("kept").select("row.*")
