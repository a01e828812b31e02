"""Pfair schedule: windows, deviation, and the places of the documents against a plain simulation."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smogline.llm import mixing as M
from smogline.llm import queries
from tests.llm.fixtures import SF_MID, docs_frame, rows_of


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9))
def test_windows_and_deviation(numbers):
    weights = {f"s{i}": w for i, w in enumerate(numbers)}
    total, seen = sum(numbers), dict.fromkeys(weights, 0)
    for slot, s in enumerate(M.pfair_slots(weights, 2 * total)):
        i = seen[s] = seen[s] + 1
        assert (i - 1) * total // weights[s] <= slot < -(-i * total // weights[s])
        for other, w in weights.items():
            assert abs(seen[other] * total - w * (slot + 1)) < total
    assert all(seen[s] == 2 * w for s, w in weights.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70), st.integers(1, 20)), min_size=1, max_size=6))
def test_schedule_places_every_block_once(sources):
    blocks, weights = ({f"s{i}": x[k] for i, x in enumerate(sources)} for k in (0, 1))
    slots = [s for p in M.schedule(blocks, weights) for s in p.slots * p.repeats]
    assert {s: slots.count(s) for s in blocks} == blocks
    # less than one block away from the share, phase by phase
    for p in M.schedule(blocks, weights):
        active = {s: weights[s] for s in p.first}
        total = sum(active.values())
        for t in range(1, len(p.slots) + 1):
            assert all(abs(p.slots[:t].count(s) * total - w * t) < total for s, w in active.items())


def test_whole_weights():
    assert M.whole_weights({"a": 0.5, "b": 0.3, "c": 0.2}, 10) == {"a": 5, "b": 3, "c": 2}
    assert sum(M.whole_weights({"a": 1, "b": 1, "c": 1}, 10).values()) == 10
    assert M.whole_weights({"a": 1.0, "b": 0.0}, 10) == {"a": 9, "b": 1}


def places(df):
    return [r.asDict() for r in df.orderBy("slot", "place", "doc_id").collect()]


def test_query_follows_the_schedule(spark):
    rows = places(queries.QUERIES["op7_pfair_mixing"](spark, SF_MID))
    docs = {r["doc_id"]: r["source"] for r in rows_of("documents", SF_MID)}
    assert {r["doc_id"]: r["source"] for r in rows} == docs and len(rows) == len(docs)
    sizes = {s: list(docs.values()).count(s) for s in set(docs.values())}
    weights = M.whole_weights({"=" + s: n ** M.FLATTEN for s, n in sizes.items()})
    plan = [s[1:] for p in M.schedule({"=" + s: -(-n // M.BLOCK_DOCS) for s, n in sizes.items()}, weights) for s in p.slots * p.repeats]
    seen = dict.fromkeys(sizes, 0)
    at = 0
    for slot, s in enumerate(plan):  # block by block, as the schedule says
        n = min(M.BLOCK_DOCS, sizes[s] - seen[s] * M.BLOCK_DOCS)
        assert [(r["slot"], r["source"], r["block"], r["place"]) for r in rows[at:at + n]] == \
            [(slot, s, seen[s], i) for i in range(n)]
        seen[s] += 1
        at += n
    assert at == len(rows)


@pytest.mark.parametrize("bucket_docs", [1, 7, 5000])
def test_null_sources_hot_source_and_repeats(spark, bucket_docs):
    docs = docs_frame(spark, [f"t{i}" for i in range(60)], extra=True)
    docs = docs.withColumn("source", F.expr("CASE WHEN doc_id < 40 THEN 'hot' WHEN doc_id < 50 THEN NULL ELSE 'b' END"))
    rows = places(M.mix(docs, {"hot": 0.5, "b": 0.5}, block_docs=4, bucket_docs=bucket_docs))
    assert sorted(r["doc_id"] for r in rows) == list(range(60))
    assert len({(r["slot"], r["place"]) for r in rows}) == 60
    assert {r["block"] for r in rows if r["source"] == "hot"} == set(range(10))
    again = M.mixed_documents(docs.union(docs), block_docs=4)
    assert again.columns == docs.columns and again.count() == 120
    assert M.mix(docs.limit(0)).collect() == [] and M.mixed_documents(docs.limit(0)).collect() == []


def test_documents_come_in_the_order_of_the_mixture(spark):
    docs = docs_frame(spark, [f"t{i}" for i in range(90)])
    order = [r["doc_id"] for r in places(M.mix(docs, block_docs=4))]
    assert [r["doc_id"] for r in M.mixed_documents(docs, block_docs=4).collect()] == order


def farthest(slots, weights, upto):
    """The largest deviation, in blocks, from the given weights over the first ``upto`` slots."""
    total = sum(map(Fraction, weights.values()))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    seen, worst = dict.fromkeys(weights, 0), Fraction(0)
    for t, s in enumerate(slots[:upto], 1):
        seen[s] += 1
        if t % 97 == 0 or t == upto:
            worst = max(worst, *(abs(seen[x] - w * t) for x, w in share.items()))
    return worst


def test_skewed_sources_keep_to_the_given_weights():
    sizes = {"big": 400_000} | {f"s{i:02}": 40_000 + i for i in range(19)}
    weights = M.flattened_weights(sizes)
    blocks = {s: n // M.BLOCK_DOCS for s, n in sizes.items()}
    slots = list(M.turns(blocks, M.whole_weights(weights)))
    assert Counter(slots) == blocks
    upto = min(max(i for i, x in enumerate(slots) if x == s) for s in sizes) + 1  # the first source to end
    assert upto > 50_000 and farthest(slots, weights, upto) < 1


def test_more_than_a_thousand_sources_keep_to_the_given_weights(spark):
    # 1,101 sources: one has half of the weight, the others share the rest unevenly
    weights = {"big": 1100.0} | {f"s{i}": 0.5 + i % 2 for i in range(1100)}
    docs = spark.range(3300).selectExpr(
        "id AS doc_id", "concat('t', id) AS text", "'en' AS lang",
        "CASE WHEN id < 1100 THEN 'big' ELSE concat('s', id % 1100) END AS source", "1L AS n_chars")
    rows = places(M.mix(docs, weights, block_docs=1))
    assert [r["slot"] for r in rows] == list(range(3300))
    slots = [r["source"] for r in rows]
    left, upto = Counter(slots), 0
    for upto, s in enumerate(slots, 1):
        left[s] -= 1
        if not left[s]:
            break
    assert upto > 1000 and farthest(slots, weights, upto) < 1


def test_sources_without_a_weight_come_last(spark):
    docs = docs_frame(spark, [f"t{i}" for i in range(30)])
    order = [r["source"] for r in places(M.mix(docs, {"src0": 2, "src1": 1, "src2": 0}, block_docs=1))]
    assert order[20:] == ["src2"] * 10 and set(order[:20]) == {"src0", "src1"}


def test_runs_of_the_written_schedule():
    blocks, weights = {"a": 300, "b": 1, "c": 0}, {"a": 3, "b": 1, "c": 1}
    rows = [r for b in M.dealt(blocks, weights) for r in b.to_pylist()]
    slots = list(M.turns(blocks, weights))
    for s in "ab":
        own = sorted((r["run"], r["slots"]) for r in rows if r["name"] == s)
        assert [at for _, run in own for at in run] == [i for i, x in enumerate(slots) if x == s]
        assert [n for n, _ in own] == list(range(len(own))) and all(len(run) == M.RUN for _, run in own[:-1])
