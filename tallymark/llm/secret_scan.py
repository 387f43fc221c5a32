"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Every long run of key characters is a candidate. Its encoding is the smallest alphabet that
holds it. Three tests ask whether it could be random over that alphabet: chi-squared uniformity,
the runs test about the middle of the alphabet, and lag-one serial correlation; Fisher's method
combines their p-values into one evidence against randomness.

Short strings of ordinary text pass such tests by chance. So the null distribution of the
evidence is learned, per encoding and length class, from consecutive windows of that length over
the prose of the whole table, folded onto the same alphabet: every text is read for every class
that has plausible candidates, from its own start, so partitions do not matter. Per class, the Benjamini-Hochberg rule then
accepts candidates that look more random than prose of that length does. The histograms that
this needs have a fixed size. A small table has little prose to compare with, and then adds
few or no spans.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, parts, strings

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones may be left out here
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")

_LOW, _UP, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: Smallest first: a candidate's encoding is the first that holds all its characters.
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "upper_hex": _DIGITS + "ABCDEF",
    "lower": _LOW,
    "upper": _UP,
    "base32": _UP + "234567",
    "base36": _DIGITS + _LOW,
    "upper_base36": _DIGITS + _UP,
    "letters": _UP + _LOW,
    "base62": _DIGITS + _UP + _LOW,
    "base64": _UP + _LOW + _DIGITS + "+/",
    "base64url": _UP + _LOW + _DIGITS + "-_",
    "mixed": _UP + _LOW + _DIGITS + "+/-_",
}
_NAMES = list(ENCODINGS)
_SETS = [frozenset(a) for a in ENCODINGS.values()]
_SIZES = [len(a) for a in ENCODINGS.values()]
_INDEX = np.zeros((len(_NAMES), 128), np.int64)
for _i, _a in enumerate(ENCODINGS.values()):
    _INDEX[_i, [ord(c) for c in _a]] = np.arange(len(_a))

#: Length classes (a candidate belongs to the greatest that it reaches) and evidence bins.
LENGTHS = np.array([16, 18, 20, 24, 32, 40, 48, 64, 96, 128])
BIN, BINS = 0.25, 80
#: One random string in a thousand has more evidence against it than this (Gamma(3) tail).
RANDOM = 11.23


class Span(NamedTuple):
    start: int
    kind: int
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind."""
    found = [Span(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [
            Span(m.start(), 1, m.end())
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= 18
        ]
    found += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


# ---- the battery ---------------------------------------------------------------------------------


def _tail(z: np.ndarray) -> np.ndarray:
    """Two-sided p-value of a standard normal, not below 1e-7."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (
        0.254829592
        + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    return np.clip(poly * np.exp(-x * x), 1e-7, 1.0)


def _chi_z(squares: np.ndarray, size: int, n: int) -> np.ndarray:
    chi = size / n * squares - n
    # Moments of the statistic for n draws, mapped to a normal by its cube root.
    k = size - 1
    spread = np.sqrt(2 / (9 * k) * max((n - 1) / n, 0.5))
    return (np.cbrt(np.maximum(chi, 0) / k) - (1 - 2 / (9 * k))) / spread


def _runs_z(ones: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    zeros = n - ones
    pairs = 2.0 * ones * zeros
    mean = pairs / n + 1
    var = np.maximum(pairs * (pairs - n) / (n * n * (n - 1)), 0)
    return np.where(var > 0, (runs - mean) / np.sqrt(np.where(var > 0, var, 1)), 6.0)


def evidence(symbols: np.ndarray, size: int) -> np.ndarray:
    """Fisher's statistic (half of it) of the three tests, for rows of equally long strings.

    Random strings have about 3 on the average, with a Gamma(3) tail; ordinary text more.
    """
    rows, n = symbols.shape
    flat = (np.arange(rows)[:, None] * size + symbols).ravel()
    counts = np.bincount(flat, minlength=rows * size).reshape(rows, size)
    z_chi = _chi_z((counts.astype(float) ** 2).sum(1), size, n)
    high = symbols >= size / 2
    z_runs = _runs_z(high.sum(1), 1 + (high[:, 1:] != high[:, :-1]).sum(1), n)
    x = symbols - symbols.mean(1, keepdims=True)
    power = (x * x).sum(1)
    r = np.where(power > 0, (x[:, 1:] * x[:, :-1]).sum(1) / np.where(power > 0, power, 1), 1.0)
    z_serial = (r + 1 / n) * np.sqrt(n)
    return -(np.log(_tail(z_chi)) + np.log(_tail(z_runs)) + np.log(_tail(z_serial)))


def _bin(value: np.ndarray) -> np.ndarray:
    return np.minimum((value / BIN).astype(int), BINS - 1)


def _uncovered(start: int, end: int, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """The stretches from start to end that no span covers, of candidates' length; spans by start."""
    for s in spans:
        if s.start >= end:
            break
        if s.start - start >= LENGTHS[0]:
            yield start, s.start
        start = max(start, s.end)
    if end - start >= LENGTHS[0]:
        yield start, end


def candidates(texts: list[str]) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """(row, start, end) of all candidates, their classes (encoding * lengths + length) and bins.

    What a fixed pattern covers is cut out of a run; the rest of it are candidates of their own.
    """
    found, groups = [], defaultdict(list)
    for row, text in enumerate(texts):
        runs = list(_CANDIDATE.finditer(text))
        spans = base_spans(text) if runs else []
        for start, end in (x for m in runs for x in _uncovered(m.start(), m.end(), spans)):
            word = text[start:end]
            chars = set(word)
            code = next(i for i, s in enumerate(_SETS) if chars <= s)
            groups[code, len(word)].append((len(found), word))
            found.append((row, start, end))
    classes, bins = np.zeros((2, len(found)), int)
    for (code, n), items in groups.items():
        at = [i for i, _ in items]
        raw = np.frombuffer("".join(w for _, w in items).encode("ascii"), np.uint8)
        symbols = _INDEX[code][raw].reshape(len(items), n)
        classes[at] = code * len(LENGTHS) + np.searchsorted(LENGTHS, n, "right") - 1
        bins[at] = _bin(evidence(symbols, _SIZES[code]))
    return found, classes, bins


#: Characters of prose that are compared at once.
_CHARS = 1 << 18
#: Characters of prose that are held at once, twice at most: a multiple of all lengths.
_PIECE = 64 * int(np.lcm.reduce(LENGTHS))


@cache
def _chi_table(size: int, n: int) -> np.ndarray:
    """Evidence of the chi-squared test by the number of equal pairs in a string."""
    pairs = np.arange(n * (n - 1) // 2 + 1)
    return -np.log(_tail(_chi_z(n + 2.0 * pairs, size, n)))


@cache
def _runs_table(n: int) -> np.ndarray:
    """Evidence of the runs test by symbols of the upper half * (n + 1) + changes of the half."""
    ones, changes = np.divmod(np.arange((n + 1) * (n + 1)), n + 1)
    return -np.log(_tail(_runs_z(ones, 1 + changes, n)))


def _equal_pairs(windows: np.ndarray, size: int) -> np.ndarray:
    """Pairs of equal symbols in each column."""
    n, rows = windows.shape
    if n >= 48:  # counting is faster than comparing
        flat = windows + np.arange(0, rows * size, size, dtype=np.int32)
        counts = np.bincount(flat.ravel(), minlength=rows * size).reshape(rows, size)
        return (np.einsum("ij,ij->i", counts, counts) - n) // 2
    same = np.empty(windows.shape, bool)
    total = np.zeros(windows.shape, np.uint8)
    for lag in range(1, n):
        np.equal(windows[lag:], windows[:-lag], out=same[lag:])
        np.add(total[lag:], same[lag:].view(np.uint8), out=total[lag:])
    return total.sum(0, dtype=np.int32)


def _starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Starts of consecutive windows of each text, and of the one that ends with the text."""
    chars = np.diff(bounds)
    times = np.where(chars >= n, -(-chars // n), 0)
    ends = times.cumsum()
    turn = np.arange(times.sum()) - np.repeat(ends - times, times)
    return np.minimum(np.repeat(bounds[:-1], times) + turn * n, np.repeat(bounds[1:], times) - n)


def prose_windows(texts: list[str], counts: np.ndarray, wanted: np.ndarray | None = None) -> None:
    """Add the evidence bins of the windows of texts to counts[class, bin].

    Each text without its blanks is cut into consecutive windows of each length, from its start
    on, and its last characters into one that ends with it; every window counts for every
    encoding. Texts shorter than a length have no window of it. The counts are sums over texts.
    If `wanted` is given, only the classes that it holds true for are counted.
    """
    wanted = np.ones(len(counts), bool) if wanted is None else wanted
    wanted = wanted.reshape(-1, len(LENGTHS))
    lengths = {size: wanted[np.array(_SIZES) == size].any(0) for size in _SIZES}
    if not wanted.any():
        return
    for part in _pieces("".join(t.split()) for t in texts):
        bounds = np.append(0, np.cumsum([len(t) for t in part], dtype=np.int64))
        codes = np.frombuffer("".join(part).encode("utf-32-le", "replace"), "<u4")
        starts = {k: _starts(bounds, int(LENGTHS[k])) for k in np.flatnonzero(wanted.any(0))}
        for size, some in lengths.items():
            if not some.any():
                continue
            mine = {k: starts[k] for k in np.flatnonzero(some)}
            bins = _window_bins((codes % size).astype(np.uint8), size, mine)
            for code in (i for i, x in enumerate(_SIZES) if x == size):
                counts[code * len(LENGTHS) : (code + 1) * len(LENGTHS)] += bins * wanted[code][:, None]


def _pieces(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in lists of some characters; long ones are cut where windows of all lengths end."""
    part, chars = [], 0
    for text in texts:
        cuts = [*range(0, max(len(text) - int(LENGTHS[-1]), 0) + 1, _PIECE), len(text)]
        for low, high in pairwise(cuts):
            part.append(text[low:high])
            chars += high - low
            if chars >= _PIECE:
                yield part
                part, chars = [], 0
    if chars:
        yield part


def _window_bins(symbols: np.ndarray, size: int, starts: dict[int, np.ndarray]) -> np.ndarray:
    """(LENGTHS, BINS): how many of the windows have an evidence of each bin; `evidence`, but faster."""
    half = (size + 1) // 2
    # One running sum of four numbers: squares and products below 2**20, symbols, upper halves.
    # Its differences are right even where it passes 64 bits.
    s = np.arange(size)
    packed = (s * s | s << 40 | (s >= half).astype(np.int64) << 54)[symbols]
    products = symbols[:-1].astype(np.int32) * symbols[1:]
    packed[1:] += products.astype(np.int64) << 20
    sums = np.zeros(len(symbols) + 1, np.int64)
    np.cumsum(packed, out=sums[1:])
    out = np.zeros((len(LENGTHS), BINS), np.int64)
    for k, all_of in starts.items():
        n = int(LENGTHS[k])
        if not len(all_of):
            continue
        runs, chi, root = _runs_table(n), _chi_table(size, n), np.sqrt(n)
        view = np.lib.stride_tricks.sliding_window_view(symbols, n)
        for at in range(0, len(all_of), _CHARS // n):
            low = all_of[at : at + _CHARS // n]
            windows = np.ascontiguousarray(view[low].T)
            upper = windows >= half
            changes = (upper[1:] != upper[:-1]).view(np.uint8).sum(0, dtype=np.uint8)
            sums_of = sums[low + n] - sums[low]
            # The product at a window's start is with the symbol before it.
            before = np.where(low > 0, products[low - 1], 0)
            total = sums_of >> 40 & 0x3FFF
            # n times the sums of products of differences from the mean.
            power = n * (sums_of & 0xFFFFF) - total * total
            ends = windows[0].astype(np.int64) + windows[-1]
            shared = n * ((sums_of >> 20 & 0xFFFFF) - before) - total * (2 * total - ends)
            shared = shared + (n - 1) / n * (total * total)
            r = np.where(power > 0, shared / np.maximum(power, 1), 1.0)
            found = chi[_equal_pairs(windows, size)] - np.log(_tail((r + 1 / n) * root))
            found += runs[(sums_of >> 54) * (n + 1) + changes]
            out[k] += np.bincount(_bin(found), minlength=BINS)
    return out


# ---- false-discovery control ---------------------------------------------------------------------


def thresholds(found: np.ndarray, prose: np.ndarray, alpha: float) -> np.ndarray:
    """Greatest accepted bin per class, or -1: Benjamini-Hochberg over binned evidence.

    A candidate's p-value is the share of prose windows of its class that look at least as random.
    Candidates that the battery itself rejects as random strings are never accepted.
    """
    below = prose.cumsum(1)
    p = (1 + below) / (1 + below[:, -1:])
    rank = found.cumsum(1)
    passing = (p * rank[:, -1:] <= alpha * rank) & (rank > 0)
    greatest = np.where(passing.any(1), BINS - 1 - passing[:, ::-1].argmax(1), -1)
    return np.minimum(greatest, int(RANDOM / BIN) - 1)


def randomness_thresholds(docs: DataFrame, text_col: str = "text", alpha: float = 0.01) -> np.ndarray:
    """Histograms of all candidates, then of all prose, then the accepted bins.

    Prose is counted for the classes where some candidate could pass as random: the other classes
    accept nothing, whatever their prose is like. Two passes over the texts, one if no candidate
    could pass.
    """
    source = docs.select(F.col(text_col).cast("string").alias("text"))

    def add_candidates(texts, counts):
        _, c, b = candidates(texts)
        np.add.at(counts, (c, b), 1)

    found = _histogram(source, add_candidates)
    wanted = found[:, : int(RANDOM / BIN)].any(1)
    prose = np.zeros_like(found)
    if wanted.any():
        prose = _histogram(source, lambda texts, counts: prose_windows(texts, counts, wanted))
    return thresholds(found, prose, alpha)


def _histogram(texts: DataFrame, add: Callable[[list[str], np.ndarray], None]) -> np.ndarray:
    """(classes, BINS): what `add` adds for the texts, over all rows."""
    shape = (len(_NAMES) * len(LENGTHS), BINS)

    def count(batches):
        counts = np.zeros(shape, np.int64)
        for batch in parts(batches):
            add(strings(batch.column(0)), counts)
        c, b = np.nonzero(counts)
        arrays = [pa.array(c), pa.array(b), pa.array(counts[c, b])]
        yield pa.RecordBatch.from_arrays(arrays, ["class", "bin", "n"])

    counts = np.zeros(shape, np.int64)
    found = map_arrow(texts, count, "class long, bin long, n long")
    for r in found.groupBy("class", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["class"], r.bin] = r.n
    return counts


def all_spans(texts: list[str], accepted: np.ndarray) -> list[list[Span]]:
    """Base spans and accepted candidates, which no base span overlaps, by start, then kind."""
    spans = [base_spans(t) for t in texts]
    found, classes, bins = candidates(texts)
    for (row, start, end), c, b in zip(found, classes, bins, strict=True):
        if b <= accepted[c]:
            spans[row].append(Span(start, 3, end))
    return [sorted(s) for s in spans]


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.01
) -> DataFrame:
    """Per row: id, spans (array of start, kind, end; code points, end exclusive).

    A null text is empty and has no spans. Rows are scanned one by one; repeated rows agree.
    Other columns are neither read nor returned. Three passes over the texts, no shuffle of them;
    the driver holds two histograms of fixed size.
    """
    accepted = randomness_thresholds(docs, text_col, alpha)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def scan(batches):
        for batch in parts(batches):
            spans = [
                [{"start": s.start, "kind": KINDS[s.kind], "end": s.end} for s in found]
                for found in all_spans(strings(batch.column(1)), accepted)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, spans array<struct<start: long, kind: string, end: long>>"
    return map_arrow(source, scan, schema).withColumnRenamed("id", id_col)


def redact(text: str, spans: list[Span], mark: str) -> str:
    """The text with every stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], mark]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def redacted_documents(
    docs: DataFrame,
    text_col: str = "text",
    alpha: float = 0.01,
    mark: str = "[SECRET]",
    length_col: str | None = None,
) -> DataFrame:
    """docs with the secrets of its texts replaced; all other columns and rows as they are.

    Null texts stay null. `length_col`, if given and there, becomes the length of changed texts.
    """
    accepted = randomness_thresholds(docs, text_col, alpha)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    packed = docs.select(
        F.struct(*others, F.lit(0).alias("_")).alias("row"),
        F.col(text_col).cast("string").alias("text"),
    )

    def scan(batches):
        for batch in parts(batches):
            texts = strings(batch.column(1))
            spans = all_spans(texts, accepted)
            clean = [redact(t, s, mark) for t, s in zip(texts, spans, strict=True)]
            null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            arrays = [batch.column(0), pa.array(clean, pa.string(), mask=null)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text"])

    schema = f"row {packed.schema['row'].dataType.simpleString()}, text string"
    out = map_arrow(packed, scan, schema)
    now = {c: F.col("row").getField(c) if c != text_col else F.col("text") for c in docs.columns}
    if length_col in now:
        changed = F.col("text").contains(mark)
        kind = docs.schema[length_col].dataType
        length = F.length("text").cast(kind)
        now[length_col] = F.when(changed, length).otherwise(now[length_col])
    return out.select(*(column.alias(c) for c, column in now.items()))
