"""Progressive centroid search against all distances, and the whole clustering against its definition."""

import hashlib
import math

import numpy as np
import pytest

from smogline.llm import queries, walsh
from tests.llm.fixtures import SF, SF_MID, rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, count=40, rounds=5, scale=256, dim=64, kind=np.int64):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted((k for k in kept if k[0] is not None), key=lambda k: (hashlib.sha256(f"2:{k[0]}".encode()).hexdigest(), k[1]))
    x = np.array([v for _, v in kept], kind)
    centroids = np.array([v for _, v in order[:count]], kind)

    def assign():
        d = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        own, _ = assign()
        for c in range(len(centroids)):
            if (own == c).any():
                centroids[c] = x[own == c].sum(0) // (own == c).sum()
    own, far = assign()
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted((i, int(c), int(d), int(far[own == c].sum()), int(far.sum()), digest[c])
                  for (i, _), c, d in zip(kept, own, far, strict=True))


def tuples(df):
    return sorted((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("sf", [SF, SF_MID])
def test_query_equals_brute_force(spark, sf):
    want = brute([(r["vec_id"], r["embedding"]) for r in rows_of("embeddings", sf)])
    assert tuples(queries.QUERIES["op13_walsh_clusters"](spark, sf)) == want


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=64)]) for i in range(90)]
    rows += rows[:9] + [(5, rows[50][1]), (200, [0.0] * 64), (201, [0.0] * 64), (202, [-3e6] * 64), (203, [2e9] + [1.0] * 63)]
    bad = [(300, None), (301, []), (302, [1.0] * 63), (303, [float("nan")] * 64), (304, [None] * 64), (305, [float("-inf")] * 64)]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], SCHEMA).repartition(7)
    for c in ("cluster", "distance", "part", "inertia", "hash"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got = tuples(walsh.cluster_report(*walsh.cluster(df)))
    # the distance to the far vector's centroid is exact also where it needs Python integers
    kept = {r[0] for r in rows}
    want = brute(rows, kind=object)
    assert {g[0] for g in got} == kept and got == want
    few = spark.createDataFrame([(*r, 1) for r in rows[:3]], SCHEMA)
    assert tuples(walsh.cluster_report(*walsh.cluster(few))) == brute(rows[:3])
    assert tuples(walsh.cluster_report(*walsh.cluster(few.limit(0)))) == []
    unknown = spark.createDataFrame([(None, rows[0][1], 1), (4, rows[1][1], 1)], SCHEMA)
    out = walsh.cluster_report(*walsh.cluster(unknown)).collect()
    assert {r["vec_id"] for r in out} == {None, 4} and {r["cluster"] for r in out} == {0}


def test_transform_is_exact_and_ordered():
    rng = np.random.default_rng(4)
    x = rng.integers(-10 ** 6, 10 ** 6, (50, 64))
    y = walsh.transform(x)
    assert (walsh.untransform(y) == 64 * x).all()
    d = ((y[:1] - y) ** 2).sum(1)
    assert (d == 64 * ((x[:1] - x) ** 2).sum(1)).all()
    assert (y[:, 0] == x.sum(1)).all() and (y[:, 1] == x[:, :32].sum(1) - x[:, 32:].sum(1)).all()
    big = np.full((1, 64), (1 << 58) + 1)
    assert walsh.transform(big)[0, 0] == 64 * ((1 << 58) + 1)


def test_progressive_search_drops_only_strictly_worse_ones():
    rng = np.random.default_rng(6)
    c = rng.integers(-50, 50, (30, 64))
    c[7] = c[3]  # a tie goes to the smaller number
    x = np.concatenate((c[rng.integers(0, 30, 300)] + rng.integers(-8, 8, (300, 64)), rng.integers(-50, 50, (100, 64))))
    near, far, looked = walsh.progressive_nearest(walsh.transform(x), walsh.transform(c))
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (near == d.argmin(1)).all() and (far == 64 * d.min(1)).all()
    assert looked < 0.7 * len(x) * len(c) * 64
