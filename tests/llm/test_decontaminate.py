"""Decontamination against a plain window search, and its offsets against the original text."""

import hashlib
import re

from smogline.llm import decontaminate as D
from smogline.llm import queries
from tests.llm.fixtures import AWKWARD, SF, docs_frame, got, rows_of
from tests.oracle import canon, duck, rows_of_spark, rows_of_sql

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        if w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    sizes = {len(p) for p in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        ids = ",".join(sorted(str(f) for f in found if f is not None))
        out.append({"doc_id": doc_id, "n_words": len(w), "n_hit": len(hit), "n_items": len(found),
                    "items_sha256": hashlib.sha256(ids.encode()).hexdigest(), "contaminated": bool(hit)})
    return out


def test_query_equals_brute_force_and_sql(spark):
    df = queries.QUERIES["op8_decontamination"](spark, SF)
    want = brute([(r["doc_id"], r["text"]) for r in rows_of("documents")],
                 [(r["item_id"], r["text"]) for r in rows_of("benchmark")])
    assert got(df) == sorted(want, key=lambda r: str(r["doc_id"]).zfill(20))
    assert sum(r["contaminated"] for r in want) > 0
    cols, rows = rows_of_spark(df)
    assert canon(rows) == canon(rows_of_sql(duck(SF), queries.ORACLE["op8_decontamination"], cols))


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
TEXTS = [*AWKWARD, f"Lead, {ITEM.upper()}! tail", "alpha-beta gamma", "Éa short ITEM; here", "xalpha beta", "short item here",
         f"{ITEM} {ITEM}", "über   short -- item. Here we ünder short item hereafter"]
ITEMS = [(1, ITEM), (2, "short item here"), (3, None), (4, "..."), (10, "short item here"), (11, ITEM + " nu xi")]


def test_awkward_texts_and_items(spark):
    docs = docs_frame(spark, TEXTS, extra=True)
    bench = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, spans string")
    want = brute(list(enumerate(TEXTS)), ITEMS)
    assert got(D.contamination_report(D.find_contamination(docs, bench))) == want
    # many small automatons give the same rows as one
    assert got(D.contamination_report(D.find_contamination(docs, bench, block_words=5))) == want


def test_offsets_map_to_the_original(spark):
    hits = got(D.find_contamination(docs_frame(spark, TEXTS), spark.createDataFrame(ITEMS, "item_id long, text string")))
    assert any(h["spans"] for h in hits)
    for h in hits:
        w = words(TEXTS[h["doc_id"]])
        cut = [x for s in h["spans"] for x in words(TEXTS[h["doc_id"]][s["start"]:s["end"]])]
        assert cut == [w[i] for i in h["hit_words"]]


def test_repeated_rows_and_empty_tables(spark):
    docs = docs_frame(spark, ["short item here"])
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    twice = D.contamination_report(D.find_contamination(docs.union(docs), bench, block_words=5))
    assert [r["n_items"] for r in got(twice)] == [2, 2]
    assert [r["contaminated"] for r in got(D.contamination_report(D.find_contamination(docs, bench.limit(0))))] == [False]
    assert D.find_contamination(docs.limit(0), bench).collect() == []


def test_items_without_an_id_and_long_items(spark):
    long = " ".join(f"w{i % 700}" for i in range(3000))
    items = [(None, "short item here"), (2, "short item here"), (None, ITEM), (7, long), (7, long), (8, long)]
    texts = [*TEXTS, long, " ".join(f"w{i}" for i in range(300, 340)), " ".join(long.split()[695:705])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(list(enumerate(texts)), items)
    for words in (D.BLOCK_WORDS, 400):
        assert got(D.contamination_report(D.find_contamination(docs_frame(spark, texts), bench, block_words=words))) == want
    pieces = D.item_pieces(bench, 10, 50).collect()
    assert max(r["n"] for r in pieces) == 50 and len({(r["item_id"], bytes(r["piece"])) for r in pieces}) == len(pieces)
