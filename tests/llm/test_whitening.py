"""Whitening against numpy over whole tables, exact sums, clustered eigenvalues and awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from __spark_entry__ import queries
from tallymark.llm.whitening import eigen, fit_whitening, lattice, product, squares, whiten

PLAIN = "/root/testdata/sf0.01"


def kept(rows):
    return [
        (r[0], [math.floor(256 * float(c)) for c in r[1]])
        for r in rows
        if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])
    ]


def against_numpy(found, rows):
    """found: collected rows of the operator; rows: (id, vector)."""
    points = kept(rows)
    fit = np.array(sorted({tuple(x) for _, x in points}))
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    covariance = y.T @ y / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    want = {}
    for key, x in points:
        x = np.array(x)
        off = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        want.setdefault(key, []).append((off, (x - sums / n) @ axes / np.sqrt(values)))
    assert len(found) == 4 * len(points)
    signs = [0] * 4
    for r in sorted(found, key=lambda r: -abs(r.whitened)):
        k = r.component - 1
        options = want[r.vec_id]
        off, z = min(options, key=lambda o: (o[0] != r.deviation, abs(abs(o[1][k]) - abs(r.whitened))))
        assert r.n == n and r.deviation == off
        signs[k] = signs[k] or (1 if z[k] * r.whitened > 0 else -1)
        assert r.whitened == pytest.approx(signs[k] * z[k], rel=1e-8, abs=1e-9)
        assert r.explained == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_matches_numpy(spark):
    found = queries()["op13_whitening"](spark, PLAIN)
    assert dict(found.dtypes)["deviation"] == "bigint"
    rows = spark.read.parquet(f"{PLAIN}/embeddings.parquet").select("vec_id", "embedding").collect()
    against_numpy(found.collect(), rows)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=5) * [4, 2, 1, 0.5, 0.1]]) for i in range(200)]
    rows += [rows[0]] * 50 + [(None, rows[1][1]), (1, rows[2][1])]
    odd = [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5)]
    plain = rows + odd
    shape = "vec_id long, embedding array<double>"
    against_numpy(whiten(spark.createDataFrame(plain, shape)).collect(), plain)
    ragged = [*plain, (304, []), (305, [1.0]), (306, [1e300] * 5)]
    clashing = spark.createDataFrame(ragged, shape).selectExpr("*", "1 as id", "2 as x", "3 as n", "4 as v")
    against_numpy(whiten(clashing).collect(), plain)


def test_empty_and_constant_tables(spark):
    shape = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], shape)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, [])], shape)).count() == 0
    same = whiten(spark.createDataFrame([(1, [0.5, -1.0]), (2, [0.5, -1.0])], shape)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation) for r in same} == {(i, k, 1, 0) for i in (1, 2) for k in (1, 2)}
    assert all((r.whitened, r.explained, r.identity_error) == (None, None, None) for r in same)
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], shape)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert all(r.explained == pytest.approx(2 - r.component) for r in line)


def test_products_keep_extended_precision():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(7, 90)), rng.normal(size=(90, 5)) * 10.0 ** rng.integers(-9, 9, (90, 5))
    found, size = product(a, b), np.abs(a) @ np.abs(b)
    for (i, j), value in np.ndenumerate(found):
        exact = sum(Fraction(x) * Fraction(y) for x, y in zip(a[i], b[:, j], strict=True))
        assert abs(Fraction(*value.as_integer_ratio()) - exact) < 1e-18 * size[i, j]


@pytest.mark.parametrize("gap", [1e-2, 1e-5, 1e-7, 1e-9, 1e-11])
def test_clustered_eigenvalues_are_resolved(gap):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    values = np.concatenate([[5, 5 - gap, 5 - 2 * gap, 3, 3 - gap], np.linspace(1, 0.1, 19)])
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, axes = eigen(matrix)
    assert np.allclose(found, values, atol=1e-14, rtol=1e-14)
    assert np.max(np.abs(axes.T @ axes - np.eye(24))) < 1e-14
    assert np.max(np.abs(matrix @ axes - axes * found)) < 2e-14
    # A vector is as sure as the rounding of the matrix itself allows, far beyond float32.
    off = np.abs(np.abs(np.sum(axes * basis, axis=0)) - 1)
    assert np.max(off) < max(1e-13, (2e-15 / gap) ** 2 * 10)


def test_equal_eigenvalues_get_an_orthonormal_basis():
    found, axes = eigen(np.diag([2.0, 2.0, 2.0, 1.0, 0.0, 0.0]))
    assert np.allclose(found, [2, 2, 2, 1, 0, 0], atol=1e-15)
    assert np.max(np.abs(axes.T @ axes - np.eye(6))) < 1e-15
    assert np.array_equal(eigen(np.zeros((3, 3)))[0], np.zeros(3))


def test_sums_of_squares_are_exact():
    for most in (10, 1 << 40, (1 << 52) - 1, 1 << 60):
        q = np.random.default_rng(2).integers(-most, most, (5, 70))
        assert squares(q) == [sum(int(v) ** 2 for v in row) for row in q]


def test_fit_does_not_follow_partitions_or_copies(spark):
    vectors = spark.read.parquet(f"{PLAIN}/embeddings.parquet")
    once = fit_whitening(lattice(vectors))
    again = fit_whitening(lattice(vectors.union(vectors).repartition(13)))
    assert (once.n, once.sums) == (again.n, again.sums)
    assert np.allclose(once.axes, again.axes, atol=1e-12) and np.allclose(once.variances, again.variances)
