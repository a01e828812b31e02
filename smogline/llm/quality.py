"""Quality classifier: similarity-weighted votes of nearest labelled neighbours in a latent-semantic space.

A text's vector is the TF-IDF of its shape n-grams (letters and digits replaced by their kind, so that the look of
prose, tables, shouting or symbol noise counts, not the language), projected on the leading singular vectors of a
bounded labelled sample (``sample_rows``). Document frequencies cover all documents. The labelled latent vectors
(sample_rows x ``dims`` numbers: a fixed bound) are broadcast; every document meets all of them in exact blocked
cosine products and its ``neighbours`` nearest vote with weight similarity ** ``sharpness``.

Defined cases: a text without any n-gram or similar neighbour (null, empty) gets the share of label 1 in the sample;
without labels every score is 0.5; a null id is held out; several labels of one id count as their maximum; repeated
rows are scored each; only ``doc_id``, ``text`` and the labels' ``doc_id``, ``quality`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import hash_sample, one_row_per, prepare, texts_of
from smogline.llm.features import codepoints, document_frequencies, idf, ngram_buckets, shapes, tf_idf
from smogline.llm.langid import held_out_column

ORDERS = (1, 2, 3)
BITS = 12
SAMPLE_ROWS = 4000
DIMS = 32
NEIGHBOURS = 25
SHARPNESS = 20
THRESHOLD = 0.3
#: Documents of one cosine product.
BLOCK = 256


@dataclass
class QualityModel:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, tfidf: np.ndarray) -> np.ndarray:
        v = tfidf @ self.axes
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def scores(self, tfidf: np.ndarray) -> np.ndarray:
        similar = self.latent(tfidf) @ self.vectors.T
        k = min(NEIGHBOURS, similar.shape[1])
        near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(similar, near, 1).astype(np.float64), 0) ** SHARPNESS
        total = weight.sum(1)
        voted = (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, voted, self.labels.mean()), 0, 1)


def _buckets(text: bytes) -> np.ndarray:
    return ngram_buckets(shapes(codepoints(text)), ORDERS, BITS)


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, text, label): one row per id, with the largest of several labels and the least of several texts."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
           .filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))
    return one_row_per(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(one, "doc_id"), "doc_id")


def leading_axes(x: np.ndarray, dims: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors by subspace iteration."""
    rng = np.random.default_rng(3)
    dims = min(dims, *x.shape)
    q = rng.standard_normal((x.shape[0], min(dims + 16, x.shape[0]))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x @ (x.T @ q))[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:dims].T


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, dims: int = DIMS) -> QualityModel | None:
    prepare(docs.sparkSession)
    n, frequency = document_frequencies(docs, _buckets, 1 << BITS)
    weights = idf(n, frequency).astype(np.float32)
    rows = labelled(docs, hash_sample_of_labels(labels, sample_rows), "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_buckets(t), return_counts=True) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([b for b, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int32()))], ["doc_id", "label", "buckets", "counts"])

    got = rows.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id long, label int, buckets array<int>, counts array<int>").toArrow().sort_by("doc_id")
    if not got.num_rows:
        return None
    x = np.zeros((got.num_rows, 1 << BITS), np.float32)
    for i, (b, c) in enumerate(zip(got.column("buckets"), got.column("counts"), strict=True)):
        x[i, b.values.to_numpy()] = c.values.to_numpy()
    x = np.log1p(x) * weights
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.where(norm > 0, norm, 1)
    model = QualityModel(weights, leading_axes(x, dims), np.empty(0), (got.column("label").to_numpy() > 0).astype(np.float64))
    model.vectors = model.latent(x)
    return model


def hash_sample_of_labels(labels: DataFrame, sample_rows: int) -> DataFrame:
    """The labels that may be learned from, down to about ``sample_rows`` by a hash of the id."""
    usable = labels.filter(F.col("doc_id").isNotNull()).filter(~held_out_column())
    return hash_sample(usable, "doc_id", sample_rows, usable.count(), "quality")


def scores_of(texts: list[bytes], model: QualityModel | None) -> np.ndarray:
    scores = np.full(len(texts), 0.5)
    for at in range(0, len(texts) if model else 0, BLOCK):
        block = texts[at:at + BLOCK]
        scores[at:at + len(block)] = model.scores(np.array([tf_idf(_buckets(t), model.idf) for t in block], np.float32))
    return scores


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = scores_of(texts_of(batch), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out_column())
    return (rows.select("doc_id", "held_out", "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold (no shuffle)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores_of(texts_of(batch), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
