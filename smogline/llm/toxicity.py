"""Toxicity: a logistic regression on words and word beginnings, regularised by counterfactuals.

Where a labelled text names an identity term, copies with the term swapped for the others of its group are made, and
the squared change of the raw score between text and copy is penalised (``fairness``): weights on the terms
themselves cancel out, so a neutral mention of a group is not taken for an insult. The l1 part of the penalty keeps
the weights few; a text counts each feature once, so a long text neither dilutes nor repeats its evidence.

Trained by follow-the-regularised-leader on a bounded sample of labelled rows (``sample_rows``, chosen by a hash of
the id); the broadcast model is 2**bits numbers. Every whole text is scored.

Defined cases: a null or empty text gets the score of a text without features; without labels every score is 0.5
(predicted 0); a null id is held out; several labels of one id count as their maximum; repeated rows are scored
each; only ``doc_id``, ``text`` and the labels' ``doc_id``, ``toxic`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import hash_sample, id_crc, prepare, texts_of
from smogline.llm.features import by_bytes, word_features
from smogline.llm.ftrl import Ftrl
from smogline.llm.quality import labelled

BITS = 20
#: Byte lengths of the word beginnings that are features of their own.
PREFIXES = (4, 5, 6)
SAMPLE_ROWS = 8000
EPOCHS = 12
#: A feature takes part if so many sample texts have it and its likelihood-ratio statistic against the label is so
#: large; what occurs once or twice would only be learned by heart.
MIN_TEXTS = 4
MIN_RATIO = 10.0
FAIRNESS = 1.0
THRESHOLD = 0.7

#: Groups of interchangeable identity terms (a parameter; lower case).
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("immigrant", "native"), ("immigrants", "natives"),
    ("femmes", "hommes"), ("femme", "homme"), ("frauen", "männer"), ("frau", "mann"), ("mujeres", "hombres"),
    ("mujer", "hombre"),
)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float


def held_out_column() -> Column:
    """Never learned from: crc32 of the id's text leaves 1 by 3, or no id."""
    return (F.pmod(id_crc(), F.lit(3)) == 1) | F.col("doc_id").isNull()


def counterfactuals(text: str, groups: Sequence[Sequence[str]]) -> list[str]:
    """The text with every identity term replaced by the next, the one after, ... of its group."""
    place = {t: (g, i) for g in groups for i, t in enumerate(g)}
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, place), key=len, reverse=True)) + r")\b", re.IGNORECASE)
    found = {place[m.lower()][0] for m in pattern.findall(text)}
    out = []
    for turn in range(1, max(map(len, found), default=1)):
        def other(m, turn=turn):
            group, i = place[m.group(0).lower()]
            return group[(i + turn) % len(group)]

        out.append(pattern.sub(other, text))
    return [t for t in out if t != text]


def _features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct feature buckets of each text."""
    out: list[np.ndarray] = []
    for _, part in by_bytes(texts):
        text, bucket = word_features(part, BITS, PREFIXES)
        key = np.unique((text << BITS) | bucket)
        cuts = np.searchsorted(key, np.arange(len(part) + 1) << BITS)
        out += [(key[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS,
          fairness: float = FAIRNESS, identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> ToxicityModel | None:
    """The model learned from labelled rows that are not held out; None without any."""
    prepare(docs.sparkSession)
    usable = labels.filter(~held_out_column())
    rows = labelled(docs, hash_sample(usable, "doc_id", sample_rows, usable.count(), "toxicity"), "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = texts_of(batch)
            own = _features(data)
            swapped = []
            for t, f in zip(data, own, strict=True):
                # only what the swap takes away and brings in: the rest of the text cancels out
                copies = _features([c.encode() for c in counterfactuals(t.decode("utf-8", "replace"), identity_terms)])
                swapped.append([{"gone": np.setdiff1d(f, c), "new": np.setdiff1d(c, f)} for c in copies])
            kind = pa.list_(pa.struct([("gone", pa.list_(pa.int32())), ("new", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(own, pa.list_(pa.int32())),
                 pa.array(swapped, kind)], ["doc_id", "label", "own", "swapped"])

    got = rows.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id long, label int, own array<int>, swapped array<struct<gone:array<int>,new:array<int>>>"
    ).toArrow().sort_by("doc_id")
    if not got.num_rows:
        return None
    examples = []
    for y, own, swapped in zip(*(got.column(c) for c in ("label", "own", "swapped")), strict=True):
        pairs = [np.array(x["gone"] + x["new"], np.int64) for x in swapped.as_py()]
        signs = [np.array([1.0] * len(x["gone"]) + [-1.0] * len(x["new"])) for x in swapped.as_py()]
        examples.append((float(y.as_py() > 0), own.values.to_numpy(), list(zip(pairs, signs, strict=True))))
    return fit(examples, epochs, fairness)


def fit(examples: list[tuple[float, np.ndarray, list]], epochs: int = EPOCHS, fairness: float = FAIRNESS) -> ToxicityModel:
    """Train on (label, feature buckets, [(changed buckets, their signs)]); the bias is one more row."""
    bias = 1 << BITS
    kept = screened(examples)
    examples = [(y, own[kept[own]], [(c[kept[c]], sign[kept[c]]) for c, sign in swapped]) for y, own, swapped in examples]
    model = Ftrl(bias + 1, 1, alpha=1.0, l1=0.1, l2=0.1)
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            y, own, swapped = examples[i]
            rows = np.append(own, bias)
            w = model.weights(rows)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            model.step(rows, w, np.full((len(rows), 1), p - y))
            for changed, sign in swapped:
                if fairness and len(changed):
                    w = model.weights(changed)
                    # derivative of fairness * (score change) ** 2, kept within the range of a label's gradient
                    change = np.clip(2 * fairness * (w[:, 0] @ sign), -1, 1)
                    model.step(changed, w, (change * sign)[:, None])
    w = model.weights()[:, 0]
    return ToxicityModel(w[:-1].astype(np.float32), float(w[-1]))


def screened(examples: list[tuple[float, np.ndarray, list]]) -> np.ndarray:
    """Which buckets are frequent and tied to the label enough to be weighted."""
    have, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for y, own, _ in examples:
        have[own] += 1
        toxic[own] += y
    n, n1 = len(examples), sum(y for y, _, _ in examples)
    ratio = np.zeros(1 << BITS)
    for seen, expected in ((toxic, have * n1 / n), (have - toxic, have * (n - n1) / n),
                           (n1 - toxic, (n - have) * n1 / n), (n - n1 - have + toxic, (n - have) * (n - n1) / n)):
        ratio += np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return (have >= MIN_TEXTS) & (ratio >= MIN_RATIO)


def score_texts(texts: list[bytes], model: ToxicityModel | None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    raw = np.full(len(texts), model.bias)
    for at, part in by_bytes(texts):
        text, bucket = word_features(part, BITS, PREFIXES)
        used = model.weights[bucket] != 0
        key = np.unique((text[used] << BITS) | bucket[used])
        raw[at:at + len(part)] += np.bincount(key >> BITS, model.weights[key & ((1 << BITS) - 1)], len(part))
    return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(texts_of(batch), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out_column())
    return (rows.select("doc_id", "held_out", "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
