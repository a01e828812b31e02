"""Substring dedup: Rabin-Karp hashes of every window of ``window`` words; repeated windows become removal intervals.

A window is removed where the same words also start in a document with a smaller id; overlapping removed
windows merge into maximal intervals.

Plan. Documents are dealt to chunks, contiguous ranges of ids of bounded size. Each chunk sends every distinct
window hash (80 bits) once to the hash's bucket, packed as byte planes, so a window that occurs in a third of
all documents arrives once per chunk, never once per occurrence. A bucket answers each chunk with one bit per
hash: "an earlier chunk has it". The chunk then joins its own first occurrences with these bits. The text moves
through one shuffle (both uses read the same exchange); nothing else but 10 bytes per distinct window of a
chunk and one bit back is moved, and neither grows with a group of copies beyond its own rows.

Hashes of 80 bits make a false match unlikely up to about 10**11 windows; ``window_hashes`` can be widened
beyond that.

Defined cases: a null text has no words; a text with fewer words than the window loses nothing; rows with
equal ids don't remove each other's words; a null id counts as smaller than every id; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import groups_for, prepare, text_bytes, texts_of
from smogline.llm.hashing import window_hashes, word_hashes

WINDOW = 13
CHUNK_BYTES = 4 << 20
BUCKET_WINDOWS = 1 << 20
#: Quantiles of the id fetched to place the chunk borders; finer chunks divide their ranges evenly.
BORDERS = 2000
NO_ID = -(1 << 63)

RESULT = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept string"


def chunk_borders(docs: DataFrame, chunks: int) -> tuple[np.ndarray, int]:
    """(ascending id borders, even parts of each range): at most BORDERS numbers, however many chunks."""
    ranges = min(chunks, BORDERS)
    points = [i / ranges for i in range(ranges + 1)]
    found = docs.agg(F.percentile_approx("doc_id", points, 20 * BORDERS)).first()[0]
    borders = np.unique(np.array(found or [0], np.int64))
    return borders, -(-chunks // ranges)


def chunk_of(ids: np.ndarray, borders: np.ndarray, parts: int) -> np.ndarray:
    """The chunk of each id: increasing with the id."""
    r = np.clip(np.searchsorted(borders, ids, "right") - 1, 0, len(borders) - 1)
    low = borders[r].astype(np.float64)
    high = borders[np.minimum(r + 1, len(borders) - 1)].astype(np.float64)
    part = (ids - low) / np.maximum(high - low, 1) * parts
    return r * parts + np.clip(part, 0, parts - 1).astype(np.int64)


class Chunk:
    """The windows of one chunk's documents, and the chunk's distinct hashes in ascending order."""

    def __init__(self, rows: pa.Table, window: int):
        ids = rows.column("doc_id").fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.window = ids[order], rows.take(pa.array(order)), window
        texts = [t for b in self.rows.to_batches() for t in texts_of(b)]
        self.texts = texts
        words, self.counts = word_hashes(texts)
        first, second, self.at = window_hashes(words, self.counts, window)
        by = np.argsort(first, kind="stable")
        f, s = first[by], second[by]
        if np.any((f[1:] == f[:-1]) & (s[1:] != s[:-1])):
            by = np.lexsort((second, first))
            f, s = first[by], second[by]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
        self.group = np.empty(len(f), np.int64)
        self.group[by] = np.cumsum(new) - 1
        self.first, self.second = f[new], s[new]
        # the smallest id in which each distinct window starts
        self.doc = np.repeat(np.arange(len(texts)), self.counts)[self.at] if len(f) else np.empty(0, np.int64)
        starts = np.flatnonzero(new)
        self.least = np.minimum.reduceat(self.ids[self.doc[by]], starts) if len(f) else np.empty(0, np.int64)

    def buckets(self, n: int) -> np.ndarray:
        """Borders of the buckets in the ascending distinct hashes."""
        bucket = ((self.first >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(n + 1).astype(np.uint64))

    def results(self, earlier: np.ndarray) -> pa.Table:
        """One row per document, given which distinct hashes an earlier chunk has."""
        repeated = earlier[self.group] | (self.ids[self.doc] > self.least[self.group]) if len(self.at) else np.empty(0, bool)
        depth = np.zeros(int(self.counts.sum()) + 1, np.int64)
        np.add.at(depth, self.at[repeated], 1)
        np.add.at(depth, self.at[repeated] + self.window, -1)
        covered = np.cumsum(depth[:-1]) > 0
        ends = np.cumsum(self.counts)
        spans, kept = [], []
        for text, a, b in zip(self.texts, ends - self.counts, ends, strict=True):
            words, mask = text.split(), covered[a:b]
            runs = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist() if mask.any() else []
            spans.append([{"start": x, "end": y} for x, y in zip(runs[::2], runs[1::2], strict=True)])
            left, at = [], 0
            for x, y in zip(runs[::2], runs[1::2], strict=True):
                left += words[at:x]
                at = y
            kept.append(b" ".join(left + words[at:] if runs else words))
        return pa.table({
            "doc_id": self.rows.column("doc_id"), "n_words": pa.array(self.counts, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "kept": pa.array(kept, pa.binary()).cast(pa.string())})


def _packed(first: np.ndarray, second: np.ndarray) -> bytes:
    """Ascending hashes as byte planes: the slowly changing high bytes lie together and compress."""
    return b"".join(x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (first, second))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 10
    planes = np.frombuffer(data, np.uint8).reshape(10, n)
    return (np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel(),
            np.ascontiguousarray(planes[8:].T).view(np.uint16).ravel())


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Per document row: n_words, the maximal removal intervals (word positions) and the kept words."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, size = text_bytes(texts)
    chunks = groups_for(spark, size, chunk_bytes)
    buckets = groups_for(spark, size // 6, bucket_windows)
    borders, parts = chunk_borders(texts, chunks)

    @F.pandas_udf("long")
    def chunk(ids: pd.Series) -> pd.Series:
        return pd.Series(chunk_of(ids.to_numpy(np.int64), borders, parts))

    dealt = (texts.withColumn("chunk", chunk(F.coalesce("doc_id", F.lit(NO_ID))))
             .repartition(chunks, "chunk"))

    def send(key, rows):
        own = Chunk(rows, window)
        cuts = own.buckets(buckets)
        full = np.flatnonzero(np.diff(cuts))
        data = [_packed(own.first[cuts[b]:cuts[b + 1]], own.second[cuts[b]:cuts[b + 1]]) for b in full]
        return pa.table({"bucket": pa.array(full, pa.int32()),
                         "chunk": pa.array(np.full(len(full), key[0].as_py()), pa.int64()),
                         "hashes": pa.array(data, pa.binary())})

    def answer(key, rows):
        rows = rows.sort_by("chunk")
        parts_ = [_unpacked(x) for x in rows.column("hashes").to_pylist()]
        first, second = (np.concatenate([p[i] for p in parts_]) for i in (0, 1))
        by = np.argsort(first, kind="stable")  # equal hashes stay in the order of their chunks
        if np.any((first[by][1:] == first[by][:-1]) & (second[by][1:] != second[by][:-1])):
            by = np.lexsort((second, first))
        seen = np.zeros(len(by), bool)
        seen[by[1:]] = (first[by[1:]] == first[by[:-1]]) & (second[by[1:]] == second[by[:-1]])
        ends = np.cumsum([len(p[0]) for p in parts_])
        out = [(c, np.packbits(seen[e - len(p[0]):e]).tobytes()) for c, e, p in
               zip(rows.column("chunk").to_pylist(), ends, parts_, strict=True) if seen[e - len(p[0]):e].any()]
        return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()),
                         "bucket": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "earlier": pa.array([b for _, b in out], pa.binary())})

    def finish(rows, bits):
        own = Chunk(rows, window)
        earlier, cuts = np.zeros(len(own.first), bool), own.buckets(buckets)
        for b, data in zip(bits.column("bucket").to_pylist(), bits.column("earlier").to_pylist(), strict=True):
            n = cuts[b + 1] - cuts[b]
            earlier[cuts[b]:cuts[b + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=n).view(bool)
        return own.results(earlier)

    hashes = dealt.groupBy("chunk").applyInArrow(send, "bucket int, chunk long, hashes binary")
    bits = (hashes.repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(answer, "chunk long, bucket int, earlier binary"))
    return (dealt.groupBy("chunk").cogroup(bits.groupBy("chunk"))
            .applyInArrow(lambda rows, bits: finish(rows, bits) if rows.num_rows else Chunk(rows, window).results(np.empty(0, bool)),
                          RESULT))


def substring_digest(result: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return result.select("doc_id", "n_words", removed.cast("long").alias("n_removed"),
                         F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
