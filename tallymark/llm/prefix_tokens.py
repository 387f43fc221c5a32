"""Token counts of every prefix of a text, by dynamic programming.

A text's encoding is the one chain of tokens in which every token encodes to itself and every
two neighbours encode to themselves. So the last token of each prefix follows from the last
tokens of shorter prefixes: it is the token that ends here and is compatible with the last
token of what stands before it. One pass gives the exact count of every prefix, and with it
the answers to "how many tokens has this prefix" and "how much of the text fits in a budget"
without encoding anything again.

No piece of the model joins a space to something before it, so a text falls into chunks
(spaces and what follows them) that are encoded independently; counts of chunks seen before
are remembered. A model with such pieces is treated as one chunk a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, strings
from tallymark.llm.words import TEXTS, Remembered, spread

#: Words that a worker remembers.
REMEMBERED = 400_000
MARK = "▁"


class PrefixCounter:
    """Counts for one sentencepiece BPE model with byte fallback and no text normalising."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        usable = (
            i
            for i in range(sp.vocab_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        )
        # Scores are rounded to 32 bits by the library: compare them as it does.
        self.score = {
            sp.id_to_piece(i).replace(MARK, " "): float(np.float32(sp.get_score(i)))
            for i in usable
        }
        #: Every beginning of a piece; true if it is a piece that encodes to itself.
        self.starts: dict[str, bool] = {}
        for piece in self.score:
            for end in range(1, len(piece)):
                self.starts.setdefault(piece[:end], False)
            self.starts[piece] = self.merge(piece) == [piece]
        self.chunks = re.compile(r" +[^ ]*")
        if any(" " in x[1:] and x.strip(" ") for x in self.score):
            self.chunks = re.compile(r"(?s).+")
        self.by_words = self.chunks.pattern.startswith(" ")
        self.known = Remembered(self._steps_of_words, REMEMBERED)
        self.fits = lru_cache(1_000_000)(self._fits)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text: join the best-scored neighbours, the left ones first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: str, right: str) -> bool:
        return self.merge(left + right) == [left, right]

    def steps(self, chunk: str) -> bytes:
        """Change of the token count at each character of a chunk, as signed bytes."""
        fits, beginnings, size = self.fits, self.starts, len(chunk)
        ending: list[list[int]] = [[] for _ in range(size + 1)]
        for start in range(size):
            end = start + 1
            ending[end].append(start)  # a single character may always stand alone
            while end < size:
                end += 1
                piece = beginnings.get(chunk[start:end])
                if piece:
                    ending[end].append(start)
                elif piece is None:
                    break
        last, count = [""], [0]
        for end in range(1, size + 1):
            for start in ending[end]:
                token = chunk[start:end]
                if start == 0 or fits(last[start], token):
                    cost = 1 if token in self.score else len(token.encode("utf-8", "replace"))
                    last.append(token)
                    count.append(count[start] + cost)
                    break
            else:
                raise AssertionError(f"no last token for {chunk[:end]!r}")
        return bytes([(b - a) & 255 for a, b in zip(count, count[1:], strict=False)])

    def _steps_of_words(self, words: list[bytes]) -> list[bytes]:
        return [self.steps(" " + w.decode("utf-8", "replace")) for w in words]

    def counts(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... len(text) characters."""
        steps = b"".join(map(self.steps, self.chunks.findall(" " + text.replace(MARK, " "))))
        return _summed(np.frombuffer(steps, np.int8)) if text else np.zeros(1, np.int64)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """`counts` of each text; null is empty."""
        for at in range(0, len(texts), TEXTS):
            part = texts.slice(at, TEXTS).fill_null("")
            # Elsewhere every space begins a chunk of its own, so words may be looked up.
            odd = pc.match_substring_regex(part, f"^$|^ |  | $|{MARK}").to_numpy(zero_copy_only=False)
            odd |= not self.by_words
            plain = pc.split_pattern(pc.if_else(pa.array(odd), "", part), " ")
            for i, steps in enumerate(spread(plain, self.known, np.int8)):
                yield self.counts(strings(part.slice(i, 1))[0]) if odd[i] else _summed(steps)


def _summed(steps: np.ndarray) -> np.ndarray:
    counts = np.cumsum(steps, dtype=np.int64)
    counts[0] = 0  # the space that the model puts before a text counts from its first character
    return counts


@cache
def counter(model: str) -> PrefixCounter:
    return PrefixCounter(model)


def pack(counts: np.ndarray) -> bytes:
    """One signed byte a character: the change of the count."""
    return np.diff(counts).astype(np.int8).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed or b"", np.int8)
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_token_counts(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    budgets: tuple[int, ...] = (),
    keep_prefixes: bool = True,
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, `fits_<budget>` and `prefixes`.

    `prefixes` holds the count of every prefix (one byte a character, see `tokens_of_prefix` and
    `prefix_within`); `fits_<budget>` is the length in characters of the longest prefix within
    the budget. A null text is empty; an empty text has no tokens; repeated rows are counted
    each; other columns are neither read nor returned. Texts of any length are read whole, in
    time linear in their length. No shuffle.
    """
    columns = ", ".join(f"fits_{b} long" for b in budgets)
    schema = "id long, n_bytes long, n_tokens long" + (columns and ", " + columns)
    schema += ", prefixes binary" if keep_prefixes else ""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    schema = schema.replace("id long", f"id {id_type}", 1)

    def run(batches):
        count = counter(model)
        for batch in batches:
            lengths = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
            rows = []
            for n_bytes, c in zip(lengths, count(batch.column(1)), strict=True):
                row = [n_bytes, int(c[-1])]
                row += [longest_within(c, b) for b in budgets]
                rows.append([*row, pack(c)] if keep_prefixes else row)
            names = ["n_bytes", "n_tokens", *(f"fits_{b}" for b in budgets)]
            kinds = [pa.int64()] * len(names)
            if keep_prefixes:
                names, kinds = [*names, "prefixes"], [*kinds, pa.binary()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", *names])

    return map_arrow(source, run, schema).withColumnRenamed("id", id_col)


def tokens_of_prefix(prefixes: str, chars: Column | int) -> Column:
    """Tokens of the first `chars` characters, from a stored `prefixes` column."""
    @F.pandas_udf("long")
    def look(packed: pd.Series, k: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(packed, k, strict=True):
            c = unpack(p)
            out.append(int(c[min(max(int(n), 0), len(c) - 1)]))
        return pd.Series(out, dtype="int64")

    return look(F.col(prefixes), F.lit(chars) if isinstance(chars, int) else chars)


def prefix_within(prefixes: str, budget: int) -> Column:
    """Characters of the longest prefix within a token budget, from a stored column."""
    @F.pandas_udf("long")
    def look(packed: pd.Series) -> pd.Series:
        return pd.Series([longest_within(unpack(p), budget) for p in packed], dtype="int64")

    return look(F.col(prefixes))
