"""Language, quality and toxicity: held-out accuracy on the given documents, and defined cases."""

import numpy as np
import pytest

from smogline.llm import langid, quality, queries, toxicity
from smogline.llm.ftrl import Ftrl, fit_temperature, softmax
from tests.llm.fixtures import AWKWARD, SF_MID, crc, docs_frame, got, rows_of


@pytest.fixture(scope="module")
def results(spark):
    return {n: got(queries.QUERIES[n](spark, SF_MID)) for n in ("op1_language_id", "op6_quality_knn", "op9_toxicity")}


def test_language(results):
    true = {r["doc_id"]: r["lang"] for r in rows_of("documents", SF_MID)}
    rows = results["op1_language_id"]
    assert {r["doc_id"] for r in rows} == set(true) and len(rows) == len(true)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and true[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize(("name", "label", "divisor", "rest", "threshold", "accuracy"),
                         [("op6_quality_knn", "quality", 5, 0, 0.3, 0.95), ("op9_toxicity", "toxic", 3, 1, 0.7, 0.88)])
def test_labels(results, name, label, divisor, rest, threshold, accuracy):
    true = {r["doc_id"]: r[label] for r in rows_of("labels", SF_MID)}
    rows = results[name]
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc(r["doc_id"]) % divisor == rest) for r in rows)
    assert all(r["predicted"] == (r["score"] >= threshold) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], true[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in true]
    assert np.mean([a == b for a, b in held]) >= accuracy


def labels_frame(spark, n):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(n)], "doc_id long, quality int, toxic int")


def test_awkward_texts_and_empty_tables(spark):
    texts = AWKWARD * 3
    docs, labels = docs_frame(spark, texts, extra=True), labels_frame(spark, len(texts))
    found = [langid.identify(docs, langid.train(docs)), quality.score(docs, quality.train(docs, labels)),
             toxicity.score(docs, toxicity.train(docs, labels))]
    for df in found:
        rows = got(df)
        assert [r["doc_id"] for r in rows] == list(range(len(texts)))
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert [r["lang_pred"] for r in got(found[0])][:3] == ["und"] * 3
    none = labels.limit(0)
    assert {r["score"] for r in got(quality.score(docs, quality.train(docs, none)))} == {0.5}
    assert {r["predicted"] for r in got(toxicity.score(docs, toxicity.train(docs, none)))} == {0}
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r["lang_pred"], r["score"]) for r in got(langid.identify(unlabelled, langid.train(unlabelled)))} == {("und", 0.0)}
    empty = docs.limit(0)
    assert langid.identify(empty, langid.train(empty)).collect() == []
    assert quality.score(empty, quality.train(empty, labels)).collect() == []
    assert toxicity.score(empty, toxicity.train(empty, labels)).collect() == []


def test_null_id_repeated_rows_and_kept_columns(spark):
    docs = docs_frame(spark, ["Le chat et la table.", "The cat and the table.", "x | y | z |"], extra=True)
    odd = docs.union(docs).union(docs)
    null = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "lang")
    rows = langid.identify(null, langid.train(docs)).collect()
    assert [r["held_out"] for r in rows] == [True] * 3
    assert langid.identify(odd, langid.train(docs)).count() == 9
    kept = quality.keep_good(docs, None)
    assert kept.columns == docs.columns and kept.count() == 3
    assert quality.keep_good(docs, None, threshold=0.6).count() == 0


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    model = Ftrl(200, 1, l1=5.0)
    for _ in range(1000):
        rows = np.append(rng.choice(199, 5, replace=False) + 1, [0] if rng.random() < 0.5 else [])
        w = model.weights(rows.astype(int))
        p = 1 / (1 + np.exp(-w.sum()))
        model.step(rows.astype(int), w, np.full((len(rows), 1), p - (0 in rows)))
    w = model.weights()[:, 0]
    assert np.argmax(w) == 0 and w[0] > 1
    assert (w[1:] == 0).mean() > 0.2


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    raw = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in softmax(raw)])
    assert abs(fit_temperature(raw * 4, labels) - 4) < 0.6
    assert fit_temperature(np.empty((0, 3)), np.empty(0, int)) == 1.0
    sure = np.eye(3)[[0, 1, 2] * 20] * 50
    assert softmax(sure / fit_temperature(sure, np.array([0, 1, 2] * 20)))[0].max() < 0.9999


def test_counterfactuals_swap_terms():
    out = toxicity.counterfactuals("Muslims and WOMEN live here.", (("women", "men"), ("muslims", "jews", "hindus")))
    assert out == ["jews and men live here.", "hindus and women live here."]
    assert toxicity.counterfactuals("Nothing here.", toxicity.IDENTITY_TERMS) == []


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    rng = np.random.default_rng(4)
    filler = [f"word{i}" for i in range(300)]

    def text(*words):
        return " ".join([*rng.choice(filler, 12), *words, *rng.choice(filler, 12)])

    # biased labels: the group is named in most toxic texts, hardly in others
    rows = [(text("idiot", "women") if i % 4 else text("idiot"), 1) if i % 2 else (text("table"), 0) for i in range(1200)]
    docs = docs_frame(spark, [t for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    neutral = [text("women").encode() for _ in range(100)]
    free = toxicity.train(docs, labels, fairness=0.0)
    fair = toxicity.train(docs, labels, fairness=20.0)
    assert toxicity.score_texts(neutral, fair).mean() < toxicity.score_texts(neutral, free).mean() - 0.1
    assert (toxicity.score_texts([text("idiot").encode() for _ in range(50)], fair) > 0.7).mean() > 0.9


def test_samples_are_bounded_whatever_an_id_holds(spark):
    """An id with a third of all rows gives one row to a sample, and every language gets into it."""
    from pyspark.sql import functions as F

    from smogline.llm import langid
    from smogline.llm.common import hash_sample
    from smogline.llm.quality import labelled

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 2000 == 1, F.lit("rare")).when(F.col("id") % 2 == 0, F.lit("x")).otherwise(F.lit("y")).alias("lang"))
    for salt in ("a", "b", "c", "d"):
        sample = hash_sample(rows, "doc_id", 3000, 60_000, salt)
        assert sample.count() < 4000 and sample.groupBy("doc_id").count().filter("count > 1").count() == 0
    own = langid.language_sample(rows, 600)
    by = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    assert set(by) == {"rare", "x", "y"} and by["rare"] >= 15 and sum(by.values()) < 1500
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0)], "doc_id long, quality int")
    assert sorted((r["doc_id"], r["label"]) for r in labelled(rows, labels, "quality").collect()) == [(7, 1), (8, 0)]
    assert hash_sample(rows.limit(0), "doc_id", 10, 0, "a").collect() == []


def test_letters():
    from smogline.llm.langid import has_letter

    assert has_letter("1 x") and has_letter("\u4e2d") and not has_letter("") and not has_letter("1 \u00b2 \u00bd \u2167 _ .")
