"""The pipeline against its operators' brute-force versions, stage by stage."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from smogline.llm import mixing, quality, queries, tokens
from smogline.llm.common import table, written
from tests.llm import test_decontaminate, test_neardup
from tests.llm.fixtures import AWKWARD, SF, docs_frame, got, rows_of


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of every stage, each written and read again."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        docs, _ = written(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_stages(spark, stages):
    docs = {r["doc_id"]: r for r in rows_of("documents")}
    good = [r["doc_id"] for r in got(queries.QUERIES["op6_quality_knn"](spark, SF)) if r["predicted"]]
    assert ids(stages[0]) == sorted(good) and 0 < len(good) < len(docs)
    unique = [r["doc_id"] for r in test_neardup.brute([(i, docs[i]["text"]) for i in good]) if r["kept"]]
    assert ids(stages[1]) == sorted(unique) and len(unique) < len(good)
    items = [(r["item_id"], r["text"]) for r in rows_of("benchmark")]
    clean = [r["doc_id"] for r in test_decontaminate.brute([(i, docs[i]["text"]) for i in unique], items) if not r["contaminated"]]
    assert ids(stages[2]) == sorted(clean) and len(clean) < len(unique)
    order = [r["doc_id"] for r in mixing.mix(stages[2]).orderBy("slot", "place").collect()]
    by_file = stages[3].select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index")
    assert [r["doc_id"] for r in by_file.collect()] == order and sorted(order) == sorted(clean)
    for df in stages[:4]:
        assert df.columns == table(spark, SF, "documents").columns
        assert all(r.asDict() == docs[r["doc_id"]] for r in df.collect())
    # the token files follow the mixture
    tokenizer, at, want = Tokenizer.from_file(tokens.default_tokenizer()), 0, []
    for i in order:
        t = [*tokenizer.encode(docs[i]["text"], add_special_tokens=False).ids, 0]
        want.append({"doc_id": i, "start": at, "n_tokens": len(t), "ids_crc32": zlib.crc32(np.array(t, "<u4").tobytes())})
        at += len(t)
    assert got(stages[4]) == sorted(want, key=lambda r: str(r["doc_id"]).zfill(20))
    assert got(queries.QUERIES["op6_quality_knn"](spark, SF))  # the operators' queries stay usable afterwards


def test_run_is_all_stages(spark, stages):
    assert got(P.run(spark, SF)) == got(stages[-1])


def test_awkward_documents_pass_every_stage(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns reach the end or are left out by a decision."""
    docs = docs_frame(spark, AWKWARD, extra=True)
    for c in ("turn", "order_id", "order_tie", "found_id", "stage_doc_id", "row", "id", "slot", "place", "name", "bucket"):
        docs = docs.selectExpr("*", f"'x' AS {c}")
    odd = docs.union(docs.limit(3)).union(docs.selectExpr("CAST(NULL AS LONG) AS doc_id", *docs.columns[1:]).limit(2))
    for frame in (odd, docs.limit(0)):
        now = frame
        for name, stage in P.STAGES:
            now, _ = written(stage(spark, now, SF), f"odd-{name}")
            if name != "tokens":
                assert now.columns == frame.columns
        assert now.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert quality.THRESHOLD == 0.3


def test_rows_without_an_id_are_copies_too(spark):
    """An exact and a near copy of a document with an id go; of a group without any id one stays; empty ones stay."""
    first, second = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(7, first), (None, first), (None, first + " more"), (None, second), (None, second), (None, second + " x"),
            (None, None), (None, ""), (9, "alone here"), (None, "no copy of this anywhere")]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", 1) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = P.dedup_stage(spark, docs, SF)
    assert left.columns == docs.columns
    stays = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    seconds = [x for x in stays if x[1] and x[1].startswith("b0 ")]
    assert len(seconds) == 1
    assert [x for x in stays if x not in seconds] == sorted(
        [(7, first), (None, None), (None, ""), (9, "alone here"), (None, "no copy of this anywhere")], key=str)
    nameless = P.dedup_stage(spark, docs.filter("doc_id IS NULL"), SF)
    assert sorted(str(r["text"])[:3] for r in nameless.collect()) == sorted(["Non", "", "no ", "a0 ", "b0 "])


def test_a_hit_in_a_row_without_an_id_leaves_the_others(spark):
    item = rows_of("benchmark")[0]["text"]
    rows = [(1, "clean words"), (None, f"lead {item} tail"), (None, "other clean words"), (None, None), (5, item), (5, "same id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = P.decontamination_stage(spark, docs, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(1, "clean words"), (None, "other clean words"), (None, None)], key=str)
