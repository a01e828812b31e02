"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm import ann, queries
from tests.llm.fixtures import SF_MID, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, score string, list string"


def brute(rows, step=20, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and np.any(v)]
    out = {}
    for i, q in good:
        if i % step == 0:
            found = {j: float((v * q).sum()) for j, v in good if j != i}
            out[i] = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_query_recall_and_scores(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in rows_of("embeddings", SF_MID)]
    want, found = brute(rows), lists(queries.QUERIES["op10_balanced_postings"](spark, SF_MID))
    assert found.keys() == want.keys()
    assert np.mean([len({j for j, _ in found[i]} & {j for j, _ in want[i]}) / 20 for i in want]) >= 0.9
    vectors = dict(rows)
    for i, near in found.items():
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(vectors[i] @ vectors[j]), abs=1e-12) for j, s in near)


def test_awkward_vectors_ties_and_small_blocks(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    data += [(60 + i, data[0][1]) for i in range(50)]  # a hot vector: equal scores everywhere
    data += [(110, None), (111, []), (112, [0.0] * 6), (113, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (114, [float("nan")] * 6),
             (115, [float("inf")] * 6), (116, [1.0, 2.0]), (120, [100.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in data], SCHEMA)
    want = brute([(i, v) for i, v in data if i != 116])
    for options in ({"ratio": 9.0}, {"ratio": 9.0, "block": 7}):
        found = lists(ann.search(df, F.col("vec_id") % 20 == 0, **options))
        assert found.keys() == want.keys()
        for i in want:
            assert [j for j, _ in found[i]] == [j for j, _ in want[i]]
    assert lists(ann.search(df.union(df), F.col("vec_id") % 20 == 0, ratio=9.0)).keys() == want.keys()


def test_few_vectors_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, "", ""), (1, [0.5, 0.0], 0, "", ""), (2, [-1.0, 1.0], 0, "", "")], SCHEMA)
    assert lists(ann.search(df, F.col("vec_id") % 20 == 0)) == {0: [(1, 0.5), (2, -1.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(df.limit(1), F.col("vec_id") % 20 == 0).collect() == []


def test_lists_are_balanced_and_reachable():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 8)) * np.where(rng.random(3000) < 0.4, 0.01, 1)[:, None]
    c = ann.balanced_centroids(x, 50)
    near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
    assert np.bincount(near, minlength=50).max() < 3000 * 0.3
    graph, seen, todo = ann.neighbour_graph(c), {0}, [0]
    while todo:
        for j in graph[todo.pop()].tolist():
            if j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) == len(c)


#: Every vector in every list: what a block reports is all that its query gets.
WIDE = {"ratio": 9.0, "boundary": 99.0, "replicas": 99}


def brute_by_id(rows, step=20, k=20):
    """As ``brute``, for ids with several rows: an id's score is the best one of its rows."""
    out = {}
    for i, q in rows:
        if i % step == 0:
            found = out.setdefault(i, {})
            for j, v in rows:
                if j != i:
                    score = float((np.array(v, float) * np.array(q, float)).sum())
                    found[j] = max(found.get(j, -np.inf), score)
    return {i: sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k] for i, found in out.items()}


def same(found, want):
    assert found.keys() == want.keys()
    for i, near in want.items():
        assert [j for j, _ in found[i]] == [j for j, _ in near]
        assert [s for _, s in found[i]] == pytest.approx([s for _, s in near], abs=1e-9)


def test_repeated_rows_take_no_place(spark):
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in data], SCHEMA)
    want = brute_by_id(data)
    for options in ({"ratio": 9.0}, {"ratio": 9.0, "block": 7}, WIDE):
        same(lists(ann.search(df.union(df), F.col("vec_id") % 20 == 0, **options)), want)


def test_an_id_with_many_rows_near_the_query(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    near = np.array(data[20][1])  # 300 rows of one id around a query, closer than all others
    data += [(121, (near * 1.5 + rng.normal(size=6) * 0.01).astype(np.float32).tolist()) for _ in range(300)]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in data], SCHEMA)
    want = brute_by_id(data)
    for options in ({"ratio": 9.0, "block": 50}, WIDE):
        same(lists(ann.search(df, F.col("vec_id") % 20 == 0, **options)), want)
    assert all(len(near) == 20 for near in lists(ann.search(df, F.col("vec_id") % 20 == 0)).values())
