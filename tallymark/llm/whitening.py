"""Whitening of embeddings: float32 eigenvectors of a distributed covariance, refined to double precision.

Sums and products over the rows are made in tasks and added by Spark; only a matrix of
dimension x dimension reaches the driver. There the eigenvectors found in float32 are corrected by
the matrix-multiplication iteration of Ogita and Aishima, whose products are formed in higher
precision (float64 slices multiplied without error, added in extended precision). Eigenvalues too close to
be told apart by an iteration form a cluster; the shifted matrix restricted to it is solved by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, materialised, parts

#: Vectors become whole numbers of this fraction.
STEPS = 256
#: Beyond this a whole number and its double are no longer the same; 1024 of them add up in 64 bits.
_LARGEST = 1 << 52
_ROWS = 1024
_ROUNDS = 12
OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


class Whitening(NamedTuple):
    """What `fit_whitening` learns: size and sums of the fit list, its leading components."""

    n: int
    sums: list[int]
    axes: np.ndarray  # dimension x components, unit columns
    variances: np.ndarray  # falling eigenvalues
    trace: float
    identity_error: float | None


def _slices(a: np.ndarray, axis: int) -> list[np.ndarray]:
    """a as a sum of float64 matrices with so few bits that their products lose none."""
    bits = np.ceil((53 + np.log2(max(a.shape[axis], 2))) / 2)
    out, rest = [], a
    for _ in range(3):
        most = np.max(np.abs(rest), axis=axis, keepdims=True)
        shift = np.ldexp(1.0, (np.frexp(most)[1] + int(bits)).astype(int))
        head = (rest + shift) - shift
        out.append(head)
        rest = rest - head
    return [*out, rest]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in extended precision, by float64 matrix products."""
    total = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for i, x in enumerate(left := _slices(a, 1)):
        for j, y in enumerate(_slices(b, 0)):
            if i + j < len(left):
                total += x @ y
    return total


def _clusters(values: np.ndarray, within: float) -> list[np.ndarray]:
    """Places of rising values whose gaps to a neighbour are `within`, as groups of two or more."""
    cuts = np.flatnonzero(np.diff(values) > within) + 1
    return [g for g in np.split(np.arange(len(values)), cuts) if len(g) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, to double precision.

    The entry of greatest size of each vector is positive. Equal eigenvalues get some
    orthonormal basis of their space.
    """
    scale = np.max(np.abs(matrix), initial=0.0)
    if scale == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scale = np.ldexp(1.0, int(np.frexp(scale)[1]))
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    one = np.eye(len(a))
    for _ in range(_ROUNDS):
        r = one - product(x.T, x)
        ax = product(a, x)
        head = ax.astype(np.float64)
        s = product(x.T, head) + product(x.T, (ax - head).astype(np.float64))
        # Evenly symmetric: what is left of rounding then only turns the vectors.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = (s - np.diag(values)).astype(np.float64)
        size = float(np.max(np.abs(values)))
        doubt = 2 * (np.linalg.norm(off, 2) + size * np.linalg.norm(r.astype(np.float64), 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > doubt
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2).astype(np.float64)
        x = x + x @ step
        groups = _clusters(values, doubt)
        for group in groups:
            # The shifted matrix in the cluster's space: its small differences keep their digits.
            part = np.ix_(group, group)
            middle = values[group].mean()
            shifted = s[part] - middle * (one[part] - r[part])
            turn = np.linalg.eigh(shifted.astype(np.float64))[1]
            x[:, group] = x[:, group] @ turn
        if np.max(np.abs(step)) < 1e-15 and doubt < 1e-14 * size:
            break
    values = values.astype(np.float64)[::-1] * scale
    x = x[:, ::-1] / np.linalg.norm(x[:, ::-1], axis=0)
    largest = x[np.argmax(np.abs(x), axis=0), np.arange(x.shape[1])]
    return values, x * np.where(largest < 0, -1.0, 1.0)


def lattice(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): vectors as whole numbers floor(256 * entry).

    Left out: vectors that are null or empty, hold a null or an entry that is not finite, or an
    entry of 2^44 or more, and vectors of another length than the commonest (of equally common
    ones the longest). Ids may be null or repeated; other columns are ignored.
    """
    slim = vectors.select(
        F.col(id_col).alias("id"), F.transform(vector_col, lambda c: c.cast("double")).alias("v")
    )

    def fits(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) * STEPS < _LARGEST)

    whole = slim.filter((F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(fits(c), F.lit(False))))
    lengths = whole.groupBy(F.size("v").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = common.length if common else 0
    x = F.transform("v", lambda c: F.floor(c * STEPS).cast("long"))
    return whole.filter(F.size("v") == length).select("id", x.alias("x"))


def _numbers(column: pa.ListArray) -> np.ndarray:
    """One row of numbers for each list; lists have one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _summed(fit: DataFrame) -> tuple[int, list[int]]:
    """Size of the fit list and the exact sum of each dimension."""

    def task(batches: Iterator[pa.RecordBatch]):
        n, total = 0, 0
        for batch in parts(batches, _ROWS):
            x = _numbers(batch.column(0))
            n, total = n + len(x), total + x.sum(axis=0).astype(object)
        if n:
            places = pa.array(range(len(total)), pa.int32())
            sums = pa.array([int(t) for t in total], pa.decimal128(38, 0))
            yield pa.record_batch([places, pa.array([n] * len(total)), sums], ["place", "n", "total"])

    rows = map_arrow(fit.select("x"), task, "place int, n long, total decimal(38,0)")
    found = rows.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = sorted(found.collect())
    return (int(found[0].n) if found else 0), [int(r.total) for r in found]


def _added(rows: DataFrame) -> list:
    """Rows (place, line) added by place: one array for each place, in order. Streams in its tasks."""

    def task(batches: Iterator[pa.RecordBatch]):
        total: dict[int, np.ndarray] = {}
        for batch in parts(batches, _ROWS):
            lines = _numbers(batch.column(1))
            for place, line in zip(batch.column(0).to_pylist(), lines, strict=True):
                total[place] = total[place] + line if place in total else line.copy()
        if total:
            yield _lines(total)

    added = map_arrow(rows.repartition("place"), task, rows.schema)
    return [r.line for r in sorted(added.collect())]


def _lines(by_place: dict[int, np.ndarray]) -> pa.RecordBatch:
    places = pa.array(list(by_place), pa.int32())
    return pa.record_batch([places, pa.array([v.tolist() for v in by_place.values()])], ["place", "line"])


def _products(fit: DataFrame, mean: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of y y', for y the centred vector, or that times `onto`."""

    def task(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in parts(batches, _ROWS):
            y = _numbers(batch.column(0)) - mean
            y = y if onto is None else y @ onto
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _lines(dict(enumerate(total)))

    return np.array(_added(map_arrow(fit.select("x"), task, "place int, line array<double>")))


def fit_whitening(points: DataFrame, components: int = 4) -> Whitening | None:
    """Leading components of the covariance (divisor n) of the distinct vectors x of `points`.

    None if there is no vector. Components without variance have no identity error.
    """
    fit = materialised(points.select("x").distinct(), "whitening-fit")
    n, sums = _summed(fit)
    if not n:
        return None
    mean = np.array([total / n for total in sums])
    covariance = _products(fit, mean) / n
    values, axes = eigen((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    values, axes = values[:components], axes[:, :components]
    real = values > len(sums) * 2.0**-50 * trace
    values = np.where(real, values, 0.0)
    error = None
    if real.any():
        scaled = axes[:, real] / np.sqrt(values[real])
        error = float(np.max(np.abs(_products(fit, mean, scaled) / n - np.eye(int(real.sum())))))
    return Whitening(n, sums, axes, values, trace, error)


def squares(q: np.ndarray) -> list[int]:
    """Exact sum of squares of each row of whole numbers."""
    if q.dtype != object and q.shape[1] <= 512 and np.max(np.abs(q), initial=0) < 1 << 52:
        high, low = q >> 26, q & ((1 << 26) - 1)
        by = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
        return [(int(a) << 52) + (int(b) << 27) + int(c) for a, b, c in zip(*by, strict=True)]
    return [int(t) for t in (q.astype(object) ** 2).sum(axis=1)]


def whitened(points: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """Per row of points and component of the model, from 1: id, component, n, deviation, whitened,
    explained, identity_error.

    deviation is the sum over the dimensions of (n * x - sum)^2, exact (null from 10^38 on);
    whitened is null for a component without variance, explained is null if there is no variance.
    """
    n, sums = model.n, model.sums
    mean = np.array([total / n for total in sums])
    real = model.variances > 0
    scaled = model.axes / np.sqrt(np.where(real, model.variances, 1.0))
    share = [float(v / model.trace) if model.trace > 0 else None for v in model.variances]
    k = len(share)
    whole = np.array(sums, dtype=object)

    def task(batches: Iterator[pa.RecordBatch]):
        for batch in parts(batches, _ROWS):
            x = _numbers(batch.column(1))
            most = int(np.max(np.abs(x), initial=0)) * n + max(map(abs, sums))
            q = x.astype(object) * n - whole if most >= 1 << 62 else x * n - whole.astype(np.int64)
            off = [d if d < 10**38 else None for d in squares(q)]
            z = (x - mean) @ scaled
            rows = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column(0).take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), n, np.int64)),
                pa.array(off, pa.decimal128(38, 0)).take(pa.array(rows)),
                pa.array(z.ravel(), mask=np.tile(~real, len(x))),
                pa.array(share * len(x), pa.float64()),
                pa.array([model.identity_error] * len(rows), pa.float64()),
            ]
            yield pa.record_batch(columns, ["id", *(c.split()[0] for c in OUT.split(", "))])

    kind = points.schema["id"].dataType.simpleString()
    out = map_arrow(points.select("id", "x"), task, f"id {kind}, {OUT}")
    return out.withColumnRenamed("id", id_col)


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`whitened` over all vectors that `lattice` keeps, by the components of their distinct values.

    Repeated rows are fitted on once and each get their rows. An empty table gives no rows. There
    are as many components as dimensions if those are fewer. Each task holds a part of the rows
    and a matrix of dimension x dimension.
    """
    points = lattice(vectors, id_col, vector_col)
    model = fit_whitening(points, components)
    if model is None:
        kind = points.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, {OUT}")
    return whitened(points, model, id_col)
