"""Neighbour-based mutual information against brute force, with a crowded spot, ties and lone points."""

import numpy as np
import pytest

from smogline.operators import neighbours as N
from smogline.session import stored


def brute_kth(x, y, k):
    d = np.maximum(np.abs(x[:, None] - x), np.abs(y[:, None] - y))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, k - 1]


def psi(n):
    return sum(1 / j for j in range(1, n)) - 0.5772156649015329


def test_digamma(spark):
    from pyspark.sql import functions as F

    got = spark.range(1, 400).select("id", N.digamma(F.col("id")).alias("p")).collect()
    assert all(abs(r["p"] - psi(r["id"])) < 1e-12 for r in got)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=2000)
    spot = rng.random(2000) < 0.3  # one cell with 30 % of the rows, another value repeated exactly
    a = np.where(spot, 0.5 + 1e-7 * rng.normal(size=2000), a)
    b = np.where(spot, 0.25 + 1e-7 * rng.normal(size=2000), 0.6 * a + rng.normal(size=2000))
    a[:5], b[:5] = [40, 41, -60, 5000, 5000], [3, 2000, 8, -4, -4]  # lone ones
    whole = rng.integers(0, 4, 2000).astype(float)
    rows = [(i, float(p), float(q), float(w), 1.0, None if i > 2 else float(i)) for i, (p, q, w) in enumerate(zip(a, b, whole, strict=True))]
    return spark.createDataFrame(rows, "i long, a double, b double, whole double, same double, few double").repartition(5)


@pytest.mark.parametrize(("k", "full"), [(3, 512), (5, 40)])
def test_distances_counts_and_information_equal_brute_force(spark, frame, k, full):
    from pyspark.sql import functions as F

    jitter = (F.pmod(F.xxhash64("i"), F.lit(1 << 30)) / float(1 << 30) - 0.5) * 1e-10
    points = N.scaled_points(frame, ["a", "whole"], "b", jitter)
    distances = stored(N.kth_distances(points, k, full), "t-distances")
    got = {(r["feature"], r["id"]): r for r in distances.collect()}
    counts = {(r["feature"], r["id"]): (r["n_x"], r["n_y"]) for r in N.axis_counts(distances).collect()}
    table = points.toPandas()
    assert len(got) == len(counts) == len(table) == 4000
    info = {}
    for name, own in table.groupby("feature"):
        x, y, ids = own["x"].to_numpy(), own["y"].to_numpy(), own["id"].tolist()
        r = brute_kth(x, y, k)
        assert [got[name, i]["distance"] for i in ids] == r.tolist()
        inner = r * (1 - 1e-12)
        n_x, n_y = (np.maximum(((v > (v - inner)[:, None]) & (v < (v + inner)[:, None])).sum(1), 1) for v in (x, y))
        assert [counts[name, i] for i in ids] == list(zip(n_x.tolist(), n_y.tolist(), strict=True))
        info[name] = max(0.0, psi(len(x)) + psi(k) - np.mean([psi(int(p)) + psi(int(q)) for p, q in zip(n_x, n_y, strict=True)]))
    if full < 100:
        return
    rows = {r["feature"]: r for r in N.neighbour_mutual_info(frame, ["a", "whole", "few"], "b", k, jitter=jitter).collect()}
    assert all(rows[c]["mutual_info"] == pytest.approx(info[c], abs=2e-6) and rows[c]["n"] == 2000 for c in info)
    assert rows["few"]["n"] == 3 and rows["few"]["mutual_info"] is None  # three rows: too few
    assert rows["a"]["mutual_info"] > rows["whole"]["mutual_info"]


def test_empty_table(spark, frame):
    assert N.neighbour_mutual_info(frame.limit(0), ["a"], "b").collect() == []
