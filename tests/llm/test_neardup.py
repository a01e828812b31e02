"""Near-duplicate components against all pairs, on the given documents and on planted groups."""

import random
import re

import numpy as np

from smogline.llm import neardup as N
from smogline.llm import queries
from tests.llm.fixtures import AWKWARD, SF, docs_frame, got, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return [{"doc_id": i, "n_shingles": len(sets[i]), "component_id": find(i), "kept": find(i) == i}
            for i in sorted(ids, key=lambda i: str(i).zfill(20))]


def test_query_equals_all_pairs(spark):
    want = brute([(r["doc_id"], r["text"]) for r in rows_of("documents")])
    assert got(queries.QUERIES["op3_minhash_dedup"](spark, SF)) == want
    assert sum(not r["kept"] for r in want) > 0


def near_group(rng, members, words, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_planted_groups_and_awkward_texts(spark):
    rng = random.Random(5)
    line = " ".join(f"common{i}" for i in range(12))
    texts = [*AWKWARD, "Same four words here", "same FOUR words here", *near_group(rng, 40, 60, 5), *near_group(rng, 25, 300, 16),
             *[f"{line} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))) for _ in range(40)]]
    rng.shuffle(texts)
    docs = docs_frame(spark, texts, extra=True)
    want = brute(enumerate(texts))
    assert got(N.near_duplicates(docs)) == want
    # small blocks: every list is compared block against block
    assert got(N.near_duplicates(docs, block=4)) == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = docs_frame(spark, ["a b c d e f", "a b c d e f"]).select("doc_id", "text")
    rows = N.near_duplicates(docs.union(docs).union(docs.selectExpr("CAST(NULL AS LONG)", "text"))).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == \
        [("0", "0")] * 2 + [("1", "0")] * 2 + [("None", "0")] * 2
    assert N.near_duplicates(docs.limit(0)).collect() == []


def test_ids_with_different_texts_share_a_component(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(40)) for x in "abcd")
    near = c.rsplit(" ", 2)[0] + " other end"
    rows = [(3, a), (5, a), (5, b), (7, b), (8, near), (9, c), (9, d), (9, None), (11, d), (2, ""), (12, ""), (12, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {2: 2, 3: 3, 5: 3, 7: 3, 8: 8, 9: 8, 11: 8, 12: 12}
    found = N.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == sorted((i, want[i], want[i] == i) for i, _ in rows)
    assert sorted((r["doc_id"], r["n_shingles"]) for r in found) == sorted((i, len(shingles(t))) for i, t in rows)


def test_sketch_estimate_and_bounds():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    b = np.unique(np.concatenate((a[:3500], rng.integers(0, 2**63, 500).astype(np.uint64))))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(N.union_estimate(np.sort(a)[:256], np.sort(b)[:256], 256) - true) < 0.15
    assert N.least_overlap(64) == 26


def test_buckets_follow_the_rows_that_block_pairs_makes(spark, monkeypatch):
    rng = random.Random(9)
    line = " ".join(f"shared{i}" for i in range(60))  # over 40 and under 75 percent of each text
    texts = [line + " " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(40)) for _ in range(60)]
    texts += near_group(rng, 30, 60, 2)
    amounts, made = [], []
    groups, pairs = N.groups_for, N.block_pairs

    def counted(*args):
        rows = pairs(*args)
        made.append(rows.count())
        return rows

    monkeypatch.setattr(N, "groups_for", lambda spark, amount, per: amounts.append((amount, per)) or groups(spark, amount, per))
    monkeypatch.setattr(N, "block_pairs", counted)
    docs = docs_frame(spark, texts)
    rows = got(N.near_duplicates(docs, block=5))
    assert rows == brute(list(enumerate(texts)))
    assert made[0] > 1000 and (made[0], 20_000) in amounts
