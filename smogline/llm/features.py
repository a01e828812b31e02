"""Hashed text features (numpy, inside tasks) and their document frequencies (summed by Spark)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import texts_of
from smogline.llm.hashing import BYTE_BASE, mix, slices

#: One odd multiplier per position of a character n-gram.
_STEPS = np.array([0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1, 0x61C88647], np.uint32)


def codepoints(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def ngram_buckets(values: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """The bucket (of 2**bits) of every n-gram of the given orders."""
    out = []
    for n in orders:
        if len(values) < n:
            continue
        h = np.full(len(values) - n + 1, n * 0x5BD1E995 & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            h = (h ^ (values[j:len(values) - n + 1 + j] * _STEPS[j])) * np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(13)
        out.append(h >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _shape_table() -> np.ndarray:
    """Code points below 0x250 to their shape: lower, upper, digit, or the character itself."""
    table = np.arange(0x250, dtype=np.uint32)
    for c in range(0x250):
        ch = chr(c)
        table[c] = ord("A") if ch.isupper() else ord("a") if ch.isalpha() else ord("0") if ch.isdigit() else c
    return table


_SHAPES = _shape_table()


def shapes(values: np.ndarray) -> np.ndarray:
    """Letters and digits become one sign per kind, all else stays: what a text looks like in any language."""
    return np.where(values < 0x250, _SHAPES[np.minimum(values, 0x24F)], np.uint32(ord("a")))


#: ASCII letters to lower case, other ASCII but digits to spaces, bytes above ASCII unchanged.
_WORD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
              for b in range(256))


def word_features(texts: list[bytes], bits: int, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and of each word's prefixes of the given byte lengths."""
    data = np.frombuffer(b" ".join(texts).translate(_WORD), np.uint8)
    step = np.diff(np.concatenate(([0], (data != 0x20).view(np.int8), [0])))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    text = np.searchsorted(begins, start, "right") - 1
    values = data.astype(np.uint64) + np.uint64(1)
    texts_, hashes = [text], [slices(values, BYTE_BASE, start, end) * np.uint64(3)]
    for p in prefixes:
        long = end - start >= p
        texts_.append(text[long])
        hashes.append(slices(values, BYTE_BASE, start[long], start[long] + p) * np.uint64(2 * p + 5))
    return np.concatenate(texts_), (mix(np.concatenate(hashes)) >> np.uint64(64 - bits)).astype(np.int64)


def by_bytes(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(first position, texts) of runs of about ``limit`` bytes, so that whole-run arrays stay bounded."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, texts[at:]


def document_frequencies(docs: DataFrame, buckets_of: Callable[[bytes], np.ndarray], size: int) -> tuple[int, np.ndarray]:
    """(documents, documents per bucket) over all rows: each task counts its rows, Spark sums by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for text in texts_of(batch):
                seen = np.zeros(size, bool)
                seen[buckets_of(text)] = True
                total += seen
                rows += 1
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], full)), pa.int32()),
                                          pa.array(np.concatenate(([rows], total[full])), pa.int64())], ["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, n = np.zeros(size, np.int64), 0
    for r in sums.collect():  # at most ``size`` + 1 rows
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return n, out


def idf(n: int, frequency: np.ndarray) -> np.ndarray:
    return np.log((1 + n) / (1 + frequency)) + 1


def tf_idf(buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The unit vector of a text: 1 + log of each bucket's count, times its inverse document frequency."""
    counts = np.bincount(buckets, minlength=len(weights)).astype(np.float32)
    v = np.log1p(counts) * weights
    norm = np.sqrt(v @ v)
    return v / norm if norm else v
