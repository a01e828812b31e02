"""Substring removal against a plain window search."""

import hashlib
import re

from smogline.llm import queries
from smogline.llm import substrings as S
from tests.llm.fixtures import AWKWARD, SF, docs_frame, got, rows_of
from tests.oracle import canon, duck, rows_of_spark, rows_of_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    least, split = {}, [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - 12) if least[tuple(w[k:k + 13])] < i for j in range(k, k + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append({"doc_id": i, "n_words": len(w), "n_removed": len(gone),
                    "kept_sha256": hashlib.sha256(kept.encode()).hexdigest()})
    return sorted(out, key=lambda r: str(r["doc_id"]).zfill(20))


def test_query_equals_brute_force_and_sql(spark):
    df = queries.QUERIES["op4_substring_dedup"](spark, SF)
    want = brute([(r["doc_id"], r["text"]) for r in rows_of("documents")])
    assert got(df) == want
    assert sum(r["n_removed"] for r in want) > 0
    cols, rows = rows_of_spark(df)
    assert canon(rows) == canon(rows_of_sql(duck(SF), queries.ORACLE["op4_substring_dedup"], cols))


P = " ".join(f"w{i}" for i in range(30))
TEXTS = [*AWKWARD, P, f"a {P} b", f"x y z {P} {P}", " ".join(P.split()[:12]), " ".join(P.split()[5:18]),
         "word " * 15, f"é {P} tail", P, P.replace(" ", " ")]


def test_awkward_texts_in_many_chunks(spark):
    docs = docs_frame(spark, TEXTS, extra=True)
    want = brute(enumerate(TEXTS))
    assert got(S.substring_digest(S.remove_repeats(docs))) == want
    assert got(S.substring_digest(S.remove_repeats(docs, chunk_bytes=4000, bucket_windows=100))) == want


def test_intervals_are_maximal(spark):
    spans = {r["doc_id"]: r["spans"] for r in got(S.remove_repeats(docs_frame(spark, [P, f"a {P} b {P}", P])))}
    assert spans == {0: [], 1: [{"start": 1, "end": 31}, {"start": 32, "end": 62}], 2: [{"start": 0, "end": 30}]}


def test_equal_ids_null_ids_and_empty_table(spark):
    docs = docs_frame(spark, [P])
    assert [r["spans"] for r in got(S.remove_repeats(docs.union(docs)))] == [[], []]
    null = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    rows = S.remove_repeats(null.union(docs.select("doc_id", "text"))).collect()
    assert {r["doc_id"]: len(r["spans"]) for r in rows} == {None: 0, 0: 1}
    assert S.remove_repeats(docs.limit(0)).collect() == []


def test_one_text_is_one_exchange(spark):
    df = S.remove_repeats(docs_frame(spark, TEXTS))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
