"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every learnable document; the weights are trained by
follow-the-regularised-leader with an elastic net on a bounded sample of them (about ``sample_rows`` in the table's
proportions, but about ``LEAST_ROWS`` of every language, chosen by a hash of the id; one row per id), of which a fifth is kept apart to fit the temperature that calibrates the scores. Every document is
then scored from its whole text. Only the model (2**bits x languages numbers) is broadcast.

Defined cases: a null text and a text without a letter (``str.isalpha``) are ``und`` with score 0, and so is everything when
nothing can be learned (no labelled row); a null id is held out; equal scores go to the language first in the
alphabet; repeated rows are scored each; only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import id_crc, one_row_per, prepare, texts_of
from smogline.llm.features import codepoints, document_frequencies, idf, ngram_buckets, tf_idf
from smogline.llm.ftrl import Ftrl, fit_temperature, softmax

ORDERS = (1, 2, 3)
BITS = 15
SAMPLE_ROWS = 3000
EPOCHS = 3
UNDETERMINED = "und"

#: Rows of each language in the sample, at least (or all it has).
LEAST_ROWS = 60


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def language_sample(rows: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows in the table's proportions, but about ``LEAST_ROWS`` of every language; one row per id."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    total, unit = sum(sizes.values()), 1 << 30
    share = {lang: int(unit * min(1.0, max(sample_rows / total, LEAST_ROWS / n))) for lang, n in sizes.items()}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair]) if share else F.create_map()
    h = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(unit))
    return one_row_per(rows.filter(h < F.element_at(shares, F.col("lang"))) if share else rows, "doc_id")


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return softmax(vectors @ self.weights / self.temperature)


def held_out_column() -> Column:
    """Never learned from: crc32 of the id's text divisible by 5, or no id."""
    return (F.pmod(id_crc(), F.lit(5)) == 0) | F.col("doc_id").isNull()


def _buckets(text: bytes) -> np.ndarray:
    return ngram_buckets(codepoints(text.lower()), ORDERS, BITS)


def _sample_vectors(rows: DataFrame, label: str) -> list[tuple[int, object, np.ndarray, np.ndarray]]:
    """(doc_id, label, buckets, counts) of a bounded sample, in the order of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_buckets(t), return_counts=True) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(label), pa.array([b for b, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int32()))], ["doc_id", label, "buckets", "counts"])

    kind = dict(rows.dtypes)[label]
    got = rows.select("doc_id", label, "text").mapInArrow(
        run, f"doc_id long, {label} {kind}, buckets array<int>, counts array<int>").toArrow()
    out = []
    for i, y, b, c in zip(*(got.column(n) for n in ("doc_id", label, "buckets", "counts")), strict=True):
        out.append((i.as_py(), y.as_py(), b.values.to_numpy(), c.values.to_numpy()))
    return sorted(out, key=lambda r: (r[0], r[1], len(r[2])))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> LanguageModel | None:
    """The model learned from the rows that are not held out; None without any."""
    prepare(docs.sparkSession)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(~held_out_column())
            .filter("lang IS NOT NULL AND text IS NOT NULL"))
    n, frequency = document_frequencies(rows, _buckets, 1 << BITS)
    if not n:
        return None
    weights = idf(n, frequency)
    sample = _sample_vectors(language_sample(rows, sample_rows), "lang")
    languages = sorted({r[1] for r in sample})
    vectors = []
    for _, lang, buckets, counts in sample:
        v = np.log1p(counts) * weights[buckets]
        vectors.append((languages.index(lang), buckets, v / max(np.sqrt(v @ v), 1e-12)))
    apart = vectors[::5] if len(vectors) >= 50 else []
    fit = [v for i, v in enumerate(vectors) if not apart or i % 5]
    model = Ftrl(1 << BITS, len(languages), alpha=1.0, l1=0.02, l2=0.02)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            y, rows_, x = fit[i]
            w = model.weights(rows_)
            p = softmax(x @ w)
            p[y] -= 1
            model.step(rows_, w, np.outer(x, p))
    w = model.weights()
    raw = np.array([x @ w[rows_] for _, rows_, x in apart]) if apart else np.empty((0, len(languages)))
    return LanguageModel(languages, weights.astype(np.float32), w.astype(np.float32),
                         fit_temperature(raw, np.array([v[0] for v in apart], int)))


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, best = [], []
            for text in texts_of(batch):
                if m is None or not has_letter(text.decode("utf-8", "replace")):
                    langs.append(UNDETERMINED)
                    best.append(0.0)
                    continue
                p = m.scores(tf_idf(_buckets(text), m.idf)).astype(float)
                langs.append(m.languages[int(p.argmax())])
                best.append(min(1.0, float(p.max())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                                              pa.array(best, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out_column())
    return (rows.select("doc_id", "held_out", "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))
