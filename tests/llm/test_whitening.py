import math

import numpy as np
import pytest
from llm_cases import SF
from pyspark.sql import functions as F

from winnow.llm import whitening
from winnow.llm.catalog import op12_whitening
from winnow.llm.whitening import deviations, fit, whiten

SCHEMA = "vec_id long, embedding array<float>, x string, n string, component int"


def brute(rows, components=4):
    """Rows, eigenvalues and whitened values by plain eigenvectors of the covariance of the distinct vectors."""
    good = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for v in {v for _, v in good}]
    dim = min(set(sizes), key=lambda d: (-sizes.count(d), d))
    good = [(i, v) for i, v in good if len(v) == dim]
    fit_rows = sorted({v for _, v in good})
    n, sums = len(fit_rows), [sum(c) for c in zip(*fit_rows, strict=True)]
    a = np.array(fit_rows) - np.array(sums) / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-9 * max(values[0], 1e-9)).sum()))
    out = {}
    for i, v in good:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True))
        y = (np.array(v) - np.array(sums) / n) @ axes[:, :k] / np.sqrt(values[:k])
        out.setdefault(i, []).append((n, deviation, y, values[:k] / values.sum()))
    return out, k


def check(df, want, k):
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, []).append(r)
    assert got.keys() == (want.keys() if k else set())
    signs = np.zeros(k)
    for i, found in got.items():
        assert len(found) == k * len(want[i])
        for r in found:
            matches = [w for w in want[i] if w[1] == r.deviation and w[0] == r.n]
            assert matches
            _, _, y, share = matches[0]
            c = r.component - 1
            if not signs[c] and abs(y[c]) > 1e-6:
                signs[c] = math.copysign(1, y[c] * r.whitened)
            assert r.whitened == pytest.approx(signs[c] * y[c], abs=1e-8) and r.explained == pytest.approx(share[c], rel=1e-9)
            assert r.identity_error < 1e-9


@pytest.mark.parametrize("scale", [1.0, 1e-2])
def test_against_eigenvectors(spark, scale):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6)) * np.array([1, 0.9, 0.5, 0.3, scale, scale])
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(150, 6)) @ mix.T + 3)]
    rows += [(i + 500, rows[0][1]) for i in range(80)]  # a very common vector counts once
    rows += [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [math.nan] * 6), (904, [math.inf] * 6), (905, [1.0, 2.0]), (None, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", "n", 7) for i, v in rows], SCHEMA).repartition(5)
    want, k = brute(rows)
    assert k == 4
    check(whiten(df, fit(df)), want, k)


def test_directions_without_variance(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), 1.0, float(2 * a), float(b)]) for i, (a, b) in enumerate(rng.integers(-5, 6, size=(60, 2)))]
    df = spark.createDataFrame([(i, v, "x", "n", 7) for i, v in rows], SCHEMA)
    want, k = brute(rows)
    assert k == 2
    check(whiten(df, fit(df)), want, k)


def test_one_vector_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], "x", "n", 7), (2, [0.5, 0.5], "x", "n", 7)], SCHEMA)
    assert whiten(df, fit(df)).count() == 0
    nothing = df.limit(0)
    assert fit(nothing).n == 0 and whiten(nothing, fit(nothing)).count() == 0
    assert whiten(nothing, fit(nothing)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_fast_integers():
    rows = np.array([[2**20, -5], [3, 4]], np.int64)
    n, sums = 2**11, (2**30, 7)
    exact = [sum((n * int(x) - s) ** 2 for x, s in zip(r, sums, strict=True)) for r in rows]
    assert deviations(rows, n, sums) == exact
    assert deviations(rows, 2**40, sums) == [None, None]


def test_triangular_solve_and_cholesky():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 5))
    r = whitening.cholesky(a.T @ a, 40)
    assert np.allclose(whitening.solve_right(a, r) @ r, a) and np.allclose(r.T @ r, a.T @ a)
    assert np.allclose(np.tril(r, -1), 0)
    whitening.cholesky(np.zeros((3, 3)), 40)  # a shift makes even this one positive definite


def test_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, k = brute(rows)
    df = op12_whitening(spark, SF)
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(df.where(F.lit(True)), want, k)
