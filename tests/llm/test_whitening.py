"""Whitening against the eigenvectors of the exact covariance, and the filter on operators with known spectra."""

import math

import numpy as np
import pytest

from smogline.llm import queries, whitening
from tests.llm.fixtures import SF, SF_MID, rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(vectors, k=8):
    """(n, deviations, eigenvalues, whitened up to sign, trace) by the definition, with Python integers and LAPACK."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(col) for col in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    y = np.array([[n * a - s for a, s in zip(row, sums, strict=True)] for row in x], float) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, deviations, values, y @ axes / np.sqrt(values), np.trace(y.T @ y) / n


def check(rows, vectors, ids, tolerance=1e-8):
    n, deviations, values, white, trace = expected(vectors)
    got = sorted(rows, key=lambda r: (r["vec_id"], r["component"]))
    assert len(got) == len(ids) * len(values)
    order = np.argsort(ids, kind="stable")
    w = np.array([r["whitened"] for r in got]).reshape(len(ids), -1)
    want = white[order]
    signs = np.sign((w * want).sum(0))
    assert np.abs(w * signs - want).max() < tolerance
    assert [r["deviation"] for r in got[::len(values)]] == [deviations[i] for i in order]
    assert {r["n"] for r in got} == {n}
    assert np.allclose([r["explained"] for r in got[:len(values)]], values / trace, rtol=1e-10)
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("sf", [SF, SF_MID])
def test_query_equals_the_exact_eigenvectors(spark, sf):
    rows = rows_of("embeddings", sf)
    out = queries.QUERIES["op11_whitening"](spark, sf)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check(out.collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]], 1) for i in range(60)]
    good += good[:7]  # repeated rows are rows of their own
    bad = [(100, None, 1), (101, [], 1), (102, [1.0, 2.0], 1), (103, [float("nan")] + [0.0] * 5, 1),
           (104, [None] + [0.0] * 5, 1), (105, [float("inf")] + [0.0] * 5, 1), (106, [1e300] + [0.0] * 5, 1)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(5)
    for c in ("part", "pos", "ids", "width", "component"):
        df = df.selectExpr("*", f"'x' AS {c}")
    n, deviations, values, white, trace = expected([v for _, v, _ in good])
    out = whitening.whiten(df).collect()
    assert len(out) == 6 * len(good) and len(values) == 6
    assert sorted({(r["vec_id"], int(r["deviation"])) for r in out}) == sorted({(g[0], d) for g, d in zip(good, deviations, strict=True)})
    unknown = spark.createDataFrame([(None, v, 1) for _, v, _ in good], SCHEMA)
    assert len(whitening.whiten(unknown).collect()) == 6 * len(good)


def test_nothing_varies(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(5)], SCHEMA)
    for df in (same, same.limit(1), same.limit(0), same.selectExpr("vec_id", "CAST(NULL AS ARRAY<DOUBLE>) AS embedding")):
        assert whitening.whiten(df).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 1) for i in range(9)], SCHEMA)
    out = whitening.whiten(line).collect()  # one direction varies: one component
    assert len(out) == 9 and out[0]["explained"] == pytest.approx(1.0)


def test_deviation_beyond_a_long():
    x = np.array([[1 << 30, 5], [-3, 7]], np.int64)
    sums = [10 ** 18, -4]
    want = [sum((10 ** 9 * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v.as_py()) for v in whitening.deviations(x, 10 ** 9, sums)] == want


@pytest.mark.parametrize("spectrum", [
    np.linspace(2, 1, 120), 1 + np.arange(120)[::-1] * 1e-4, np.r_[np.full(12, 3.0), np.linspace(2.9, 0, 108)],
    np.r_[1e6, np.linspace(1, 0.5, 119)], np.r_[[5, 4], np.zeros(118)], np.ones(120)])
def test_filter_on_known_spectra(spectrum):
    rng = np.random.default_rng(1)
    basis, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    v = basis * spectrum @ basis.T
    calls = []

    def times(q):
        calls.append(q.shape[1])
        return v @ q

    values, vectors, residuals = whitening.leading_pairs(times, 120, 8)
    assert np.allclose(values, np.sort(spectrum)[::-1][:8], atol=1e-10 * spectrum.max())
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    assert residuals.max() <= 1e-12 * spectrum.max() and max(calls) == 24


def test_polynomial_is_chebyshev():
    d = np.linspace(0.1, 4, 30)
    q = np.ones((30, 1))
    out = whitening.chebyshev_filter(lambda y: d[:, None] * y, q, d[:, None] * q, 7, 0.5, 2.0, 4.0)
    t = lambda x: np.polynomial.chebyshev.chebval(x, [0] * 7 + [1])
    assert np.allclose(out[:, 0], t((d - 1.25) / 0.75) / t((4.0 - 1.25) / 0.75))
