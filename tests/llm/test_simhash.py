"""SimHash fingerprints against Spark's own XXH64, components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from smogline.llm import queries, simhash
from tests.llm.fixtures import AWKWARD, SF, SF_MID, docs_frame, got, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs):
    """Smallest id per component of (id, fingerprint) rows."""
    prints = sorted({f for _, f in pairs})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    a = np.array(prints, np.uint64)
    for i, f in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3) + i + 1:
            root[find(prints[j])] = find(f)
    first = {}
    for i, f in pairs:  # an id joins its classes
        if i is not None:
            root[find(first.setdefault(i, f))] = find(f)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [least.get(find(f)) for _, f in pairs]


def brute(rows):
    pairs = [(i, fingerprint(t)) for i, t in rows]
    return sorted(((i, f"{f:016x}", c) for (i, f), c in zip(pairs, components(pairs), strict=True)), key=str)


def tuples(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF, SF_MID])
def test_query_equals_all_pairs(spark, sf):
    want = brute([(r["doc_id"], r["text"]) for r in rows_of("documents", sf)])
    assert tuples(queries.QUERIES["op12_simhash_dedup"](spark, sf)) == want


def test_hashes_are_sparks(spark):
    texts = ["one two three", "é ß 漢字", "x" * 100]
    want = [r[0] for r in docs_frame(spark, texts).orderBy("doc_id").select(F.xxhash64("text")).collect()]
    assert [int(np.uint64(next(simhash.shingle_hashes(t.encode()))[0]).view(np.int64)) for t in texts] == want


def test_long_texts_piece_by_piece(monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(400)}" + rng.choice([" ", "\n", "\t "]) * rng.randrange(3) for _ in range(3000))
    want = [fingerprint(t) for t in (text, "a b", "  a  ", "a b  c", "")]
    monkeypatch.setattr(simhash, "PIECE", 50)
    monkeypatch.setattr(simhash, "HASHES", 64)
    assert simhash.fingerprints([t.encode() for t in (text, "a b", "  a  ", "a b  c", "")]).tolist() == want


def near_copies(rng, groups=6, members=30):
    out = []
    for _ in range(groups):
        base = [f"b{rng.randrange(10 ** 6)}" for _ in range(300)]
        out += [" ".join(base)]
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(300)] = f"e{rng.randrange(10 ** 6)}"
            out.append(" ".join(w))
    return out


def test_awkward_texts_and_hot_cells(spark):
    rng = random.Random(7)
    texts = [*AWKWARD, *near_copies(rng), *(f"{rng.choice('abcd')} {rng.choice('efgh')}" for _ in range(40))]
    rng.shuffle(texts)
    want = brute(enumerate(texts))
    docs = docs_frame(spark, texts, extra=True)
    for c in ("fp", "cell", "component_id", "fingerprint", "n", "hot"):
        docs = docs.selectExpr("*", f"'x' AS {c}")
    assert tuples(simhash.near_duplicates(docs)) == want
    assert len({c for _, _, c in want}) < len(want) - 60
    # every cell with more than two members is cut into blocks of two
    assert tuples(simhash.near_duplicates(docs, hot_rows=2, block=2)) == want


def test_repeated_and_null_ids_and_empty_table(spark):
    texts = near_copies(random.Random(2), groups=4, members=1)
    rows = [(3, texts[0]), (5, texts[1]), (5, texts[2]), (7, texts[3]), (7, texts[3]), (9, texts[4]), (None, texts[5]),
            (None, texts[7]), (8, None), (6, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(simhash.near_duplicates(docs)) == brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_bounds_and_cells_find_every_close_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    flips = np.zeros(300, np.uint64)
    for _ in range(3):
        flips |= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    fp = np.concatenate((base, base ^ flips))
    point = simhash.embed(fp)
    assert (np.bitwise_count(point[:300] ^ point[300:]) <= np.bitwise_count(flips)).all()
    cell, who, probe = simhash.cell_members(fp)
    u, v = simhash.forest([cell], fp[who], probe, np.ones(len(cell), bool))
    assert len(u) == 300 and {tuple(sorted(p)) for p in zip(u.tolist(), v.tolist(), strict=True)} == \
        {tuple(sorted(p)) for p in zip(base.tolist(), (base ^ flips).tolist(), strict=True)}


def test_results_are_sorted_and_typed(spark):
    out = simhash.near_duplicates(docs_frame(spark, ["a b c d", None]))
    assert out.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert got(out)[1]["fingerprint"] == "0" * 16
