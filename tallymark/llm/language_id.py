"""Language identification: sparse multinomial logistic regression over TF-IDF character n-grams.

Document frequencies come from all labelled documents. The weights are fitted on a bounded,
hash-chosen sample of them by follow-the-regularised-leader with elastic-net penalties (FTRL
proximal), which leaves most weights at zero; a temperature fitted on a part of the sample that
training has not seen calibrates the probabilities. Scoring is one pass over whole texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, parts, strings
from tallymark.llm.ngrams import text_gram_counts

ORDERS, BITS = (1, 2, 3), 15
BINS = 1 << BITS
#: Most labelled documents to fit the weights on, all languages together, and most languages.
SAMPLE, LANGUAGES = 6000, 500
UNDETERMINED = "und"


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray  # (BINS,)
    weights: np.ndarray  # (BINS, languages)
    bias: np.ndarray  # (languages,)
    temperature: float


def _counts(texts: list[str]):
    return text_gram_counts([t.lower() for t in texts], ORDERS, BITS)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents with an n-gram of each bin, over all rows, and the number of rows."""

    def run(batches):
        df, n = np.zeros(BINS, np.int64), 0
        for batch in parts(batches):
            texts = strings(batch.column(0))
            n += len(texts)
            for counts in _counts(texts):
                df += counts > 0
        bins = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bins, -1)), pa.array(np.append(df[bins], n))], ["bin", "n"]
        )

    counted = map_arrow(docs.select(F.col(text_col).cast("string")), run, "bin long, n long")
    found = {r.bin: r.n for r in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    n = found.pop(-1, 0)
    df = np.zeros(BINS, np.int64)
    df[list(found)] = list(found.values())
    return df, n


def _sampled(docs: DataFrame, label: Column, most: int, id_col: str, text_col: str) -> list:
    """(label, part of a hash, bins, counts) of at most about `most` rows, as many of each label.

    Rows are chosen by a hash of id and text against a rate per label, so nothing is sorted.
    Repeated rows (same label, id and text) count once.
    """
    labelled = docs.withColumn("label", label).filter("label is not null")
    sizes = labelled.groupBy("label").agg(F.count("*").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "label").limit(LANGUAGES)
    sizes = {r.label: r.n for r in sizes.collect()}
    if not sizes:
        return []
    each = max(1, most // len(sizes))
    rates = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    unit = F.pmod(F.xxhash64(F.lit(7), id_col, text_col), F.lit(1_000_003)) / 1_000_003
    chosen = labelled.withColumn("unit", unit).filter(F.col("unit") < rates[F.col("label")])
    chosen = chosen.select("label", F.xxhash64(F.lit(8), id_col, text_col).alias("h"), text_col)
    chosen = chosen.dropDuplicates(["label", "h"])

    def run(batches):
        for batch in parts(batches):
            bins, counts = [], []
            for c in _counts(strings(batch.column(2))):
                at = np.flatnonzero(c)
                bins.append(at.astype("<u4").tobytes())
                counts.append(c[at].astype("<f4").tobytes())
            arrays = [batch.column(0), batch.column(1), pa.array(bins, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["label", "h", "bins", "counts"])

    rows = map_arrow(chosen, run, "label string, h long, bins binary, counts binary").collect()
    return sorted(rows, key=lambda r: (r.h, r.label))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with logarithmic term frequency, of length 1 (0 if there are no n-grams)."""
    x = (1 + np.log(np.maximum(counts, 1))) * idf * (counts > 0)
    size = np.sqrt((x * x).sum())
    return x / size if size > 0 else x


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    # Not by a matrix library: its threads would fight with the session's for small products.
    return np.einsum("i,ij->j", x, w)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    epochs: int = 4,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.01,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bins and one bias, classes) of rows (bins, values, class), by FTRL proximal."""
    z, n = np.zeros((2, BINS + 1, classes))

    def weights(at):
        zz = z[at]
        free = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(zz) > l1, -(zz - np.sign(zz) * l1) / free, 0.0)

    for _ in range(epochs):
        for bins, values, label in rows:
            at = np.append(bins, BINS)
            x = np.append(values, 1.0)
            w = weights(at)
            logits = _times(x, w)
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            g = np.outer(x, p)
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w = weights(np.arange(BINS + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood, by golden section over its log."""

    def loss(t):
        x = logits / np.exp(t)
        x = x - x.max(1, keepdims=True)
        return -(x[np.arange(len(x)), labels] - np.log(np.exp(x).sum(1))).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    if not len(labels):
        return 1.0
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(
    docs: DataFrame,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Model | None:
    """Learn from the rows of docs that have a language; None if there are none.

    `sample` bounds the rows that weights are fitted on; document frequencies are of all rows.
    The LANGUAGES most frequent languages are learned.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(id_col, text_col, lang_col)
    rows = _sampled(labelled, F.col(lang_col).cast("string"), sample, id_col, text_col)
    if not rows:
        return None
    df, n = document_frequencies(labelled, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    languages = sorted({r.label for r in rows})
    examples = []
    for r in rows:
        bins = np.frombuffer(r.bins, "<u4").astype(np.int64)
        x = weighted(np.frombuffer(r.counts, "<f4"), idf[bins])
        examples.append((bins, x, languages.index(r.label)))
    held = [e for e, r in zip(examples, rows, strict=True) if r.h % 5 == 0]
    kept = [e for e, r in zip(examples, rows, strict=True) if r.h % 5 != 0] or examples
    weights, bias = fit_ftrl(kept, len(languages))
    held = held or examples
    logits = np.array([_times(x, weights[bins]) + bias for bins, x, _ in held])
    temperature = fit_temperature(logits, np.array([y for _, _, y in held]))
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias, temperature)


def predict_language(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, lang_pred, score (calibrated probability of lang_pred).

    A null text, a text without a letter, and any text if there is no model are `und` with score
    0. Only the text is used; other columns are neither read nor returned. No shuffle.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in parts(batches):
            texts = strings(batch.column(1))
            found, scores = [], []
            for text, counts in zip(texts, _counts(texts), strict=True):
                if model is None or not any(map(str.isalpha, text)):
                    found.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                at = np.flatnonzero(counts)
                x = weighted(counts[at], model.idf[at])
                logits = (_times(x, model.weights[at]) + model.bias) / model.temperature
                p = np.exp(logits - logits.max())
                best = int(p.argmax())
                found.append(model.languages[best])
                scores.append(float(p[best] / p.sum()))
            arrays = [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "lang_pred", "score"])

    schema = f"id {id_type}, lang_pred string, score double"
    return map_arrow(source, run, schema).withColumnRenamed("id", id_col)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of an id as text leaves a remainder; false for a null id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
