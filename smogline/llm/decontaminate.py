"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark windows.

Texts are normalised (A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by single spaces);
every window of ``window`` consecutive item words is one pattern (an item with fewer words is one pattern).
The automaton reads each document once and reports all, also overlapping, occurrences; word positions map
back to character offsets of the original text.

The benchmark is cut into pieces (a long item into several that share window - 1 words; equal pieces of one item count
once), and these are dealt to blocks of a bounded number of words. Each block is a broadcast of known size, its
automaton is built once per worker process, and the per-block findings of a document are united by an
aggregation, so a benchmark of any size is handled (a normal one is a single block and needs no shuffle at all).

Defined cases: a null or empty text has no words and no hits; a long text is scanned whole, in memory of a few times its
size; an item without words has no windows; equal windows of several items report every item; all items without an
id are reported as one item, null; repeated document rows each get their row; an empty benchmark hits nothing; only ``doc_id``/``text`` and ``item_id``/``text`` are read, so further columns never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import prepare, texts_of, written

WINDOW = 10
#: Words of benchmark text in one automaton (about 100 bytes of automaton per word and window).
BLOCK_WORDS = 200_000
#: A block's words are at least this many pieces, so that dealing pieces by hash fills blocks evenly.
PIECES = 20

#: Bytes of UTF-8 text to normalised bytes: A-Z to a-z, other ASCII that is no word byte to a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                for b in range(256))

HITS = "doc_id long, n_words long, hit_words array<int>, item_ids array<long>, spans array<struct<start:int,end:int>>"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def item_order(item_id: int | None) -> tuple[bool, int]:
    return item_id is None, item_id or 0


def build_automaton(items: list[tuple[int | None, bytes]], window: int):
    """An automaton whose patterns are the items' windows; values are (words in the pattern, item ids)."""
    import ahocorasick

    patterns: dict[bytes, set[int | None]] = {}
    for item_id, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            patterns.setdefault(b" ".join(words[i:i + window]), set()).add(item_id)
    if not patterns:
        return None
    found = ahocorasick.Automaton()
    for text, ids in patterns.items():
        # a latin-1 view of the bytes: one character per byte, spaces on both sides hold word boundaries
        found.add_word(f" {text.decode('latin-1')} ", (text.count(b" ") + 1, tuple(sorted(ids, key=item_order))))
    found.make_automaton()
    return found


def scan(text: bytes, automaton) -> tuple[int, np.ndarray, list[int]]:
    """(words, positions of the hit words, item ids) of one document."""
    words = normal_words(text)
    if automaton is None or not words:
        return len(words), np.empty(0, np.int32), []
    normal = f" {b' '.join(words).decode('latin-1')} "
    items: set[int | None] = set()
    ends: list[tuple[int, int]] = []
    for end, (n, ids) in automaton.iter(normal):
        ends.append((end, n))
        items.update(ids)
    if not ends:
        return len(words), np.empty(0, np.int32), []
    spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(spaces, [e for e, _ in ends])  # the space after word w is number w + 1
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, last - np.array([n for _, n in ends]), 1)
    np.add.at(depth, last, -1)
    return len(words), np.flatnonzero(np.cumsum(depth[:-1]) > 0).astype(np.int32), sorted(items, key=item_order)


def _char_spans(text: bytes, hits: np.ndarray) -> list[dict[str, int]]:
    """Runs of adjacent hit words as character offsets [start, end) of the original text."""
    if not len(hits):
        return []
    data = np.frombuffer(text.translate(_NORMAL), np.uint8)
    inside = np.concatenate(([0], (data != 0x20).view(np.int8), [0]))
    step = np.diff(inside)
    begin, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    cut = np.flatnonzero(np.diff(hits) > 1)
    first, last = hits[np.concatenate(([0], cut + 1))], hits[np.concatenate((cut, [len(hits) - 1]))]
    return [{"start": int(chars[begin[a]]), "end": int(chars[stop[b]])} for a, b in zip(first, last, strict=True)]


def item_pieces(items: DataFrame, window: int, piece_words: int) -> DataFrame:
    """(item_id, piece, n): the distinct pieces of the items' normalised texts and their words. Every window lies in a piece."""
    step = max(1, piece_words - window + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column("item_id").to_pylist(), texts_of(batch), strict=True):
                words = normal_words(text)
                cuts = range(0, max(1, len(words) - window + 1), step) if words else ()
                pieces = [words[at:at + step + window - 1] for at in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * len(pieces), pa.int64()), pa.array([b" ".join(p) for p in pieces], pa.binary()),
                     pa.array([len(p) for p in pieces], pa.int64())], ["item_id", "piece", "n"])

    return items.mapInArrow(run, "item_id long, piece binary, n long").distinct()


_AUTOMATA: dict[str, object] = {}


def automaton_of(key: str, items: list[tuple[int | None, bytes]], window: int):
    """The automaton of a block, one per worker process (the last one used is kept)."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = build_automaton(items, window)
    return _AUTOMATA[key]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: n_words, hit_words (positions), item_ids (items with occurring windows) and spans
    (character offsets of the hit runs in the original text)."""
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    pieces, _ = written(item_pieces(items, window, max(window, block_words // PIECES)), "benchmark")
    blocks = max(1, -(-int(pieces.agg(F.sum("n")).first()[0] or 0) // block_words))
    texts = docs.select("doc_id", "text")
    if blocks > 1:  # a row number for each document row, so that per-block findings of equal ids stay apart
        texts = texts.withColumn("copy", F.xxhash64("text"))
    found = None
    for k in range(blocks):
        part = pieces if blocks == 1 else pieces.filter(F.pmod(F.xxhash64("item_id", "piece"), F.lit(blocks)) == k)
        rows = [(r["item_id"], bytes(r["piece"])) for r in part.collect()]
        shared, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            automaton = automaton_of(key, shared.value, window)
            for batch in batches:
                data = texts_of(batch)
                got = [scan(t, automaton) for t in data]
                columns = [batch.column("doc_id").cast(pa.int64()), pa.array([g[0] for g in got], pa.int64()),
                           pa.array([g[1] for g in got], pa.list_(pa.int32())),
                           pa.array([g[2] for g in got], pa.list_(pa.int64())),
                           pa.array([_char_spans(t, g[1]) for t, g in zip(data, got, strict=True)],
                                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
                names = ["doc_id", "n_words", "hit_words", "item_ids", "spans"]
                if "copy" in batch.schema.names:
                    columns.append(batch.column("copy"))
                    names.append("copy")
                yield pa.RecordBatch.from_arrays(columns, names)

        hits = texts.mapInArrow(run, HITS + (", copy long" if blocks > 1 else ""))
        found = hits if found is None else found.unionByName(hits)
    if blocks == 1:
        return found
    united = found.withColumn("n_rows", F.lit(1)).groupBy("doc_id", "copy").agg(
        F.first("n_words").alias("n_words"), (F.count(F.lit(1)) / blocks).cast("int").alias("rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    return (united.withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))
            .select("doc_id", "n_words", "hit_words", "item_ids", "spans"))


def contamination_report(hits: DataFrame) -> DataFrame:
    """The digest columns of ``find_contamination``."""
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return hits.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
                       F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                       (F.size("hit_words") > 0).alias("contaminated"))
