"""Best-fit packing of token sequences by a configuration linear program.

1. Documents become pieces of at most `capacity` tokens; only longer documents are cut.
2. The histogram of piece lengths (at most `capacity` numbers, however many documents) goes to
   the driver. A configuration is a multiset of lengths that fits in one sequence. The linear
   program "fewest sequences that cover the histogram" is solved by multiplicative weights:
   lengths that lag behind gain weight, and a knapsack dynamic program finds the configuration
   of the greatest weight. The fractional solution is rounded down; what is left is packed by
   best-fit decreasing, again by configurations, so the plan has a bounded size.
3. Every piece finds its sequence and offset from its rank among the pieces of its length. Ranks
   come from counts per task and length, so no length is ever gathered in one place.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, materialised, prefix_sums
from tallymark.llm.words import TEXTS, Remembered, spread

CAPACITY = 4096
#: Words whose ids a worker remembers.
REMEMBERED = 600_000


# The steps of a tokenizer file that ignores case, drops white space, and cuts there and between
# letters, digits and signs.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_words(tokenizer: str) -> bool:
    """Whether the file (its text) is known to give a text the ids of its words in a row, in any case, and
    those of a word and the full stop or comma behind it apart."""
    steps = json.loads(tokenizer)
    before = steps["pre_tokenizer"] or {}
    split, *rest = before.get("pretokenizers") or [{}]
    known = {"type": "Split", "pattern": {"Regex": _CUTS}, "behavior": "Removed", "invert": True}
    return (
        (steps["normalizer"] or {}).get("normalizers") == _NORMALIZERS
        and split == known
        and all(r["type"] == "ByteLevel" and not (r["add_prefix_space"] or r["use_regex"]) for r in rest)
        and steps["post_processor"] is None
        and steps["model"]["type"] == "BPE"
        and not steps["model"]["dropout"]
        and all("<|" in t["content"] and not t["normalized"] for t in steps["added_tokens"])
    )


class WordIds:
    """Ids of whole texts by a `tokenizers` file.

    If the file is one that `cuts_words`, words are looked up in lower case and without the full
    stop or comma behind them, those seen before in memory; checked against the library's
    whole-text encoding in the tests. With any other file whole texts are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = cuts_words(self.tokenizer.to_str())
        self.ids = Remembered(self._encode, REMEMBERED)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_little(e.ids) for e in found]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; null is empty."""
        if not self.by_words:
            for text in texts.to_pylist():
                yield np.frombuffer(self._encode([(text or "").encode("utf-8", "replace")])[0], "<u4")
            return
        for at in range(0, len(texts), TEXTS):
            part = texts.slice(at, TEXTS).fill_null("")
            plain = pc.replace_substring_regex(
                pc.ascii_lower(part), pattern="([a-z])([.,])", replacement=r"\1 \2"
            )
            # Special tokens are case-sensitive: leave texts that may have them as they are.
            part = pc.if_else(pc.match_substring(part, "<|"), part, plain)
            yield from spread(pc.ascii_split_whitespace(part), self.ids, "<u4")


def _little(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces_of(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of every document, with the task that made them and their rank in it by length.

    Columns: id, piece, start, length, ids_crc32, task, task_rank. A null text is empty; every
    document ends with `end_id`, so an empty one has one piece of one token.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    id_arrow = pa.int64() if id_type == "bigint" else None
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "piece", "start", "length", "ids_crc32", "task", "task_rank"]

    def run(batches):
        encode = word_ids(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        step = 4 * capacity
        for batch in batches:
            ids, cols = batch.column(0), [[] for _ in range(6)]
            take = []
            for row, tokens in enumerate(encode(batch.column(1))):
                raw = tokens.tobytes() + end
                for k, at in enumerate(range(0, len(raw), step)):
                    part = raw[at : at + step]
                    n = len(part) // 4
                    take.append(row)
                    values = (k, at // 4, n, zlib.crc32(part), task, int(seen[n]))
                    for c, v in zip(cols, values, strict=True):
                        c.append(v)
                    seen[n] += 1
            kinds = [pa.int32(), *[pa.int64()] * 5]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            taken = ids.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.cast(id_arrow or taken.type), *arrays], names)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, task long, task_rank long"
    return map_arrow(source, run, schema)


# ---- the plan ------------------------------------------------------------------------------------

Plan = list[tuple[dict[int, int], int]]  # configurations: {length: pieces a sequence}, sequences


def _knapsack(items: list[tuple[int, int, float]], capacity: int) -> dict[int, int]:
    """Multiset of the greatest value. items: (length, most pieces, value a piece)."""
    parts = []
    for length, most, value in items:
        n = 1
        while most > 0:
            n = min(n, most)
            parts.append((length, n, n * length, n * value))
            most -= n
            n *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(parts), capacity + 1), bool)
    for i, (_, _, size, value) in enumerate(parts):
        if size > capacity:
            continue
        with_it = best[: capacity + 1 - size] + value
        better = with_it > best[size:]
        taken[i, size:] = better
        best[size:] = np.where(better, with_it, best[size:])
    room, found = capacity, {}
    for i in range(len(parts) - 1, -1, -1):
        if taken[i, room]:
            length, n, size, _ = parts[i]
            found[length] = found.get(length, 0) + n
            room -= size
    return found


def fractional_cover(
    histogram: dict[int, int], capacity: int, rounds: int, rate: float = 0.25, considered: int = 64
) -> list[tuple[dict[int, int], float]]:
    """Configurations and fractional multiplicities that cover the histogram about evenly.

    Each round prices a length at its share of a sequence times a weight that falls as the
    length is covered, looks for the best configuration among the `considered` lengths of the
    greatest weight, and takes it for `rate` of what its scarcest length has.
    """
    lengths = np.array(sorted(histogram))
    need = np.array([histogram[x] for x in lengths], float)
    covered, found = np.zeros(len(lengths)), {}
    index = {int(x): i for i, x in enumerate(lengths)}
    group_of = np.arange(len(lengths)) * considered // max(considered, len(lengths))
    groups = np.unique(group_of, return_index=True)[1]
    for _ in range(rounds):
        weight = np.exp(-(covered - covered.min()))
        if covered.min() >= 1.5:
            break
        lead = np.maximum.reduceat(weight, groups)
        best = np.repeat(lead, np.diff([*groups, len(lengths)])) == weight
        top = np.flatnonzero(best)[np.unique(group_of[best], return_index=True)[1]]
        items = [
            (int(lengths[i]), int(min(need[i], capacity // lengths[i])), lengths[i] / capacity * weight[i])
            for i in top
        ]
        config = _knapsack(items, capacity)
        step = rate * min(need[index[x]] / n for x, n in config.items())
        for x, n in config.items():
            covered[index[x]] += n * step / need[index[x]]
        key = tuple(sorted(config.items()))
        found[key] = found.get(key, 0.0) + step
    return [(dict(k), v) for k, v in found.items()]


def best_fit_patterns(left: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram: fill a sequence with the longest piece that fits,
    again and again, and use that pattern as often as its lengths last."""
    lengths = np.array(sorted(left), dtype=np.int64)
    counts = np.array([left[x] for x in lengths.tolist()], dtype=np.int64)
    plan: Plan = []
    while True:
        there = counts > 0
        lengths, counts = lengths[there], counts[there]
        if not len(lengths):
            return plan
        room, config, top = capacity, {}, len(lengths)
        while top:
            i = int(np.searchsorted(lengths[:top], room, "right")) - 1
            if i < 0:
                break
            n = int(min(counts[i], room // lengths[i]))
            config[int(lengths[i])] = n
            room -= n * int(lengths[i])
            top = i
        at = np.searchsorted(lengths, list(config))
        times = int(min(counts[i] // n for i, n in zip(at, config.values(), strict=True)))
        for i, n in zip(at, config.values(), strict=True):
            counts[i] -= n * times
        plan.append((config, times))


def pack_histogram(
    histogram: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None
) -> Plan:
    """A plan that holds every piece of the histogram exactly once."""
    left = {x: n for x, n in histogram.items() if n > 0}
    if any(not 0 < x <= capacity for x in left):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    plan: Plan = [({capacity: 1}, left.pop(capacity))] if capacity in left else []
    if not left:
        return plan
    rounds = min(3000, 8 * len(left)) if rounds is None else rounds
    found = fractional_cover(left, capacity, rounds)
    covered: dict[int, float] = {}
    for config, v in found:
        for x, n in config.items():
            covered[x] = covered.get(x, 0) + v * n / left[x]
    # No length is covered more than once, so what rounding leaves is a thinner like of the whole.
    scale = 1 / max(covered.values(), default=1)
    for config, v in found:
        times = int(v * scale)
        if times > 0:
            plan.append((config, times))
            for x, n in config.items():
                left[x] -= n * times
    return plan + best_fit_patterns({x: n for x, n in left.items() if n}, capacity)


def slots(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, in order of rank: first rank, first sequence, pieces a sequence, first offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, times in plan:
        offset = 0
        for x, n in sorted(config.items(), reverse=True):
            first = ranks.get(x, 0)
            found.setdefault(x, []).append((first, sequence, n, offset))
            ranks[x] = first + n * times
            offset += n * x
        sequence += times
    return {x: tuple(np.array(c) for c in zip(*rows, strict=True)) for x, rows in found.items()}


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty and still have their end token. Repeated rows (the same id and text)
    are packed each. An empty table gives no rows. Other columns are neither read nor returned.
    The driver holds the histogram and the plan, both bounded by `capacity`.
    """
    pieces = materialised(
        pieces_of(docs, tokenizer, end_id, capacity, id_col, text_col), "packing-pieces"
    )
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(pack_histogram(histogram, capacity))
    first = prefix_sums(per_task, ["length"], "task", "n", "first").drop("n")
    ranked = pieces.join(first, ["length", "task"]).select(
        *["id", "piece", "start", "length", "ids_crc32"],
        (F.col("first") + F.col("task_rank")).alias("rank"),
    )

    def place(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros((2, len(rank)), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, starts = np.unique(length[order], return_index=True)
            for x, rows in zip(kinds, np.split(order, starts[1:]), strict=True):
                first, base, n, at = table[int(x)]
                i = np.searchsorted(first, rank[rows], "right") - 1
                q = rank[rows] - first[i]
                sequence[rows] = base[i] + q // n[i]
                offset[rows] = at[i] + q % n[i] * x
            arrays = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
            names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    id_type = pieces.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_arrow(ranked, place, schema).withColumnRenamed("id", id_col)
