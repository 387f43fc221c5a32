"""Quality scores by positive-unlabelled learning.

Only trusted good documents and unlabelled ones are used. A linear model over n-grams of
character classes and a few statistics of words and lines minimises the non-negative unbiased
risk: prior * (loss of positives as good) + max(0, loss of unlabelled as bad - prior * loss of
positives as bad). The class prior is estimated first, by the best-bin rule on a classifier of
positives against unlabelled. Scoring is one pass over whole texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, parts, strings
from tallymark.llm.ngrams import codes, gram_counts
from tallymark.llm.shingles import chunks, shingles, word_hashes

ORDERS, BITS = (1, 2, 3, 4), 11
BINS = 1 << BITS
STATS = 14
SIZE = BINS + STATS
#: Most trusted positives, and most unlabelled documents, that the model is fitted on.
POSITIVES, UNLABELLED = 3000, 6000

_CLASS = np.arange(0x10000, dtype=np.uint32)
for _i in range(0x10000):
    _c = chr(_i)
    if _c.isupper():
        _CLASS[_i] = ord("A")
    elif _c.isalpha():
        _CLASS[_i] = ord("a")
    elif _c.isdigit():
        _CLASS[_i] = ord("0")
    elif _c != "\n" and _c.isspace():
        _CLASS[_i] = ord(" ")


def features(texts: list[str]) -> np.ndarray:
    """(texts, SIZE): logarithmic n-gram frequencies of character classes, and statistics."""
    out = np.zeros((len(texts), SIZE), np.float32)
    for low, high in chunks(texts):
        part = texts[low:high]
        raw, bounds = codes(part)
        kinds = np.where(raw < 0x10000, _CLASS[np.minimum(raw, 0xFFFF)], ord("a")).astype(np.uint32)
        for i, counts in enumerate(gram_counts(kinds, bounds, ORDERS, BITS)):
            n = max(bounds[i + 1] - bounds[i], 1)
            out[low + i, :BINS] = np.log1p(counts * (1000.0 / n))
        out[low:high, BINS:] = _statistics(part, kinds, bounds)
    return out


def _distinct(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, rows))
    r, v = rows[order], values[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=n)


def _statistics(texts: list[str], kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(texts)
    words, per_text = word_hashes(texts)
    rows = np.repeat(np.arange(n), per_text)
    chars = np.maximum(np.diff(bounds), 1)
    some = np.maximum(per_text, 1)
    text_of = np.repeat(np.arange(n), np.diff(bounds))

    def share(mask):
        return np.bincount(text_of[mask], minlength=n) / chars

    upper, lower, space = kinds == ord("A"), kinds == ord("a"), kinds == ord(" ")
    digit, line = kinds == ord("0"), kinds == ord("\n")
    same = (rows[1:] == rows[:-1]) & (words[1:] == words[:-1])
    shingle_rows, _, times = shingles(texts, 5)
    places = np.maximum(np.bincount(shingle_rows, times, minlength=n), 1)
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts]
    line_n = np.array([max(len(x), 1) for x in lines])
    line_kinds = np.array([len(set(x)) for x in lines])
    return np.stack(
        [
            np.log1p(per_text),
            np.minimum(chars / some, 40) / 10,
            share(upper),
            share(lower),
            share(digit),
            share(space) + share(line),
            share(~(upper | lower | digit | space | line)),
            _distinct(rows, words, n) / some,
            np.bincount(rows[1:][same], minlength=n) / some,
            np.bincount(shingle_rows[times > 1], times[times > 1], minlength=n) / places,
            line_kinds / line_n,
            np.minimum(chars / line_n, 2000) / 1000,
            np.log1p(line_n),
            per_text < 10,
        ],
        axis=1,
    )


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _minimise(gradient, size: int, steps: int, rate: float = 0.01) -> np.ndarray:
    """Adam with a falling rate; the last parameter is the bias."""
    w, m, v = np.zeros((3, size + 1), np.float32)
    for t in range(1, steps + 1):
        g = gradient(w).astype(np.float32)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = (m / np.float32(1 - 0.9**t)) / (np.sqrt(v / np.float32(1 - 0.999**t)) + np.float32(1e-8))
        w = w - np.float32(rate * (1 - t / (steps + 1))) * step
    return w


def _batch(rng: np.random.Generator, x: np.ndarray, size: int = 512) -> np.ndarray:
    return x[rng.integers(0, len(x), min(size, len(x)))]


def _linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    # Not by a matrix library: its threads would fight with the session's for small products.
    return np.einsum("ij,j->i", x, w[:-1]) + w[-1]


def _mean_gradient(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return np.append(np.einsum("i,ij->j", slope.astype(np.float32), x), slope.sum()) / len(x)


def fit_against_unlabelled(p: np.ndarray, u: np.ndarray, steps: int = 400, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression of positives against unlabelled, both sides weighing the same."""
    rng = np.random.default_rng(1)

    def gradient(w):
        a, b = _batch(rng, p), _batch(rng, u)
        up, down = -_sigmoid(-_linear(a, w)), _sigmoid(_linear(b, w))
        return _mean_gradient(a, up) + _mean_gradient(b, down) + decay * np.append(w[:-1], 0)

    return _minimise(gradient, p.shape[1], steps)


def best_bin_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled scores: the least ratio of the shares above a cut.

    Cuts where the sampling error is large are held back by the error's size.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(np.quantile(p, np.linspace(0, 0.9, 91)))
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    error = np.sqrt(1 / len(p)) + np.sqrt(1 / len(u))
    ratio = above_u / above_p
    best = int(np.argmin((above_u + error) / above_p))
    return float(np.clip(ratio[best], 0.05, 0.98))


def fit_non_negative(
    p: np.ndarray, u: np.ndarray, prior: float, steps: int = 3000, decay: float = 1e-2
) -> np.ndarray:
    """Weights and bias of the least non-negative unbiased risk under the logistic loss."""
    rng = np.random.default_rng(2)

    def gradient(w):
        a, b = _batch(rng, p), _batch(rng, u)
        fa, fb = _linear(a, w), _linear(b, w)
        bad = np.logaddexp(0, fb).mean() - prior * np.logaddexp(0, fa).mean()
        unlabelled = _mean_gradient(b, _sigmoid(fb)) - prior * _mean_gradient(a, _sigmoid(fa))
        g = prior * _mean_gradient(a, -_sigmoid(-fa))
        # A negative estimate of a risk is overfitting: step back from it instead.
        g = g + unlabelled if bad >= 0 else -unlabelled
        return g + decay * np.append(w[:-1], 0)

    return _minimise(gradient, p.shape[1], steps)


def _rows(chosen: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Features of a bounded number of rows, in an order that depends on their texts alone.

    Rows repeated with the same id and text count once.
    """

    def run(batches):
        for batch in parts(batches):
            raw = [f.tobytes() for f in features(strings(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["h", "x"])

    once = F.xxhash64(F.lit(17), id_col, text_col).alias("once")
    chosen = chosen.select(once, F.xxhash64(text_col).alias("h"), text_col)
    chosen = chosen.dropDuplicates(["once", "h"]).select("h", text_col)
    rows = sorted(map_arrow(chosen, run, "h long, x binary").collect())
    return np.array([np.frombuffer(r.x, np.float32) for r in rows]).reshape(len(rows), SIZE)


def _thinned(df: DataFrame, most: int, seed: int, *key: str) -> DataFrame:
    """About `most` rows by a hash of the key; all if there are fewer."""
    rate = min(1.0, most / max(df.count(), 1))
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_003)) < rate * 1_000_003)


def fit_quality_model(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model | None:
    """Learn from docs and the ids of trusted good documents among them (column `id_col`).

    `positives` and `unlabelled` bound what is fitted on; rows are chosen by a hash of the id.
    None if there are no trusted documents among docs.
    """
    ids = trusted.select(F.col(id_col).alias("trusted_id")).filter("trusted_id is not null").distinct()
    ids = _thinned(ids, positives, 11, "trusted_id")
    # At most about `positives` ids, by the rate above.
    good = docs.select(id_col, text_col).join(F.broadcast(ids), F.col(id_col) == F.col("trusted_id"))
    p = _rows(good, id_col, text_col)
    u = _rows(_thinned(docs.select(id_col, text_col), unlabelled, 13, id_col, text_col), id_col, text_col)
    if not len(p) or not len(u):
        return None
    mean, scale = u.mean(0), u.std(0) + 0.05
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (p, u))
    w = fit_against_unlabelled(p[::2], u[::2])
    held_p, held_u = (p[1::2], u[1::2]) if len(p) > 1 and len(u) > 1 else (p, u)
    prior = best_bin_prior(_linear(held_p, w), _linear(held_u, w))
    w = fit_non_negative(p, u, prior)
    # The best bin errs upwards, so no larger share of unlabelled documents may pass as good.
    w[-1] -= max(0.0, float(np.quantile(_linear(u, w), 1 - prior)))
    return Model(mean, scale, w[:-1].astype(np.float32), float(w[-1]), prior)


def score_quality(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, score (0 to 1, higher is better), predicted (1 if the score is at least 0.5).

    A null text is scored as an empty one; without a model every score is 0.5. Only the text is
    used; other columns are neither read nor returned. No shuffle.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in parts(batches):
            score = np.full(len(batch), 0.5)
            if model:
                score = _sigmoid(model.logits(features(strings(batch.column(1)))).astype(float))
            arrays = [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "score", "predicted"])

    schema = f"id {id_type}, score double, predicted int"
    return map_arrow(source, run, schema).withColumnRenamed("id", id_col)
