"""Token-id output: ORC files of token ids with row indexes and Bloom filters on the document id.

Documents are range-partitioned and sorted by id, encoded where they lie, and written as one ORC file per
partition: the ids are an integer-run-length-encoded list column, row indexes (min/max per ``row_stride``
rows) and Bloom filters on ``doc_id`` let a reader skip stripes, and stripes of one file can be read by
different tasks. Every row carries its file's number and its start within the file, so global positions need
only one sum per file, never a pass over the ids in one task.

Encoding: the byte-level vocabulary encodes a text piecewise. A space between two non-space characters (and
likewise a line feed) always begins a piece, so the distinct pieces of a batch are found by array operations on the
UTF-8 bytes, looked up in a bounded table, and only unseen ones go through the tokenizer; texts with runs of white
space, white space of another kind or the string of an added token go through it whole. The tokenizer is used as it is.

Defined cases: a null text is an empty one (only the end id); strings of special tokens get the ids that the library gives
them; a long text is encoded whole, in memory of a few times its size; rows with equal ids are ordered by a hash of their
text; an empty table gives an empty output; only the id and ``text`` (and the given order columns) are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import prepare
from smogline.llm.hashing import mix
from smogline.session import scratch_path

END_ID = 0
#: Pieces kept in a worker's table (about 60 bytes each).
CACHE_PIECES = 2_000_000
ROW_STRIDE = 1000
STRIPE_BYTES = 16 << 20

FILE_SCHEMA = "file_no int, row_no long, doc_id long, start_in_file long, n_tokens long, ids array<int>"

_MARKS = frozenset(".,;:!?")
#: Bytes of a piece compared by array operations; longer pieces are compared one by one.
KEY_BYTES = 24

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_ODD = _BLANK.copy()
_ODD[[0x20, 0x0A]] = False
#: First two bytes of all white space above ASCII (some other characters share them).
_ODD_PAIRS = [(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class PieceEncoder:
    """ids of whole texts, from a bounded table of pieces (a piece holds the space or line feed before its word).

    The table is sorted by a 64-bit hash of the piece; a second one tells pieces with equal first hashes apart. Pieces
    longer than ``KEY_BYTES`` are kept by their text.
    """

    def __init__(self, tokenizer_path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added if t.content]
        self.marks = dict(zip(sorted(_MARKS), self._whole(sorted(_MARKS)), strict=True))
        self.limit = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.known, self.second = np.empty(0, np.uint64), np.empty(0, np.uint64)  # sorted hashes, and their seconds
        self.row = np.empty(0, np.int64)  # the piece's row of starts and lengths
        self.long: dict[str, int] = {}
        self.rows = self.used = 0
        self.starts, self.lengths, self.pool = np.empty(1024, np.int64), np.empty(1024, np.int64), np.empty(4096, np.int32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _with_room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate((array, np.empty(max(size, 2 * len(array)) - len(array), array.dtype)))

    def _learn(self, new: list[str]) -> np.ndarray:
        """Rows of unseen pieces. A final punctuation mark after a letter is a piece of its own to the vocabulary, so
        such pieces are put together from the word without it."""
        ends = [p[-1:] in _MARKS and p[-2:-1].isalpha() for p in new]
        place: dict[str, int] = {}
        stems = [place.setdefault(p[:-1] if e else p, len(place)) for p, e in zip(new, ends, strict=True)]
        whole = self._whole(list(place))
        ids = [whole[i] + self.marks[p[-1]] if e else whole[i] for i, p, e in zip(stems, new, ends, strict=True)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total, n = int(lengths.sum()), len(new)
        self.starts, self.lengths = (self._with_room(x, self.rows + n) for x in (self.starts, self.lengths))
        self.pool = self._with_room(self.pool, self.used + total)
        self.starts[self.rows:self.rows + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.rows:self.rows + n] = lengths
        self.pool[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.rows, self.used = self.rows + n, self.used + total
        return np.arange(self.rows - n, self.rows)

    def _rows(self, first: np.ndarray, second: np.ndarray, long: np.ndarray, piece) -> np.ndarray:
        """The rows of distinct pieces in the order of ``first``; ``piece(i)`` are the texts of some of them."""
        if self.rows > self.limit:
            self._forget()
        at = np.searchsorted(self.known, first)
        near = np.minimum(at, max(len(self.known) - 1, 0))
        there = np.zeros(len(first), bool)
        if len(self.known):
            there = (self.known[near] == first) & (self.second[near] == second) & ~long
        rows = np.full(len(first), -1)
        rows[there] = self.row[near[there]]
        if long.any():
            at_long = np.flatnonzero(long)
            texts = piece(at_long)
            unseen = [p for p in dict.fromkeys(texts) if p not in self.long]
            self.long.update(zip(unseen, self._learn(unseen).tolist(), strict=True))
            rows[at_long] = [self.long[p] for p in texts]
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = self._learn(piece(new))
            add = new[np.concatenate(([True], first[new][1:] != first[new][:-1]))]
            if len(self.known):
                add = add[self.known[near[add]] != first[add]]
            self.known, self.second, self.row = (np.insert(old, at[add], x[add]) for old, x in (
                (self.known, first), (self.second, second), (self.row, rows)))
        return rows

    def _regular(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of texts whose only white space is single spaces and line feeds."""
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        gaps = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & ((data == 0x20) | (data == 0x0A)))
        starts = np.concatenate((gaps + 1, begin))
        order = np.argsort(starts, kind="stable")  # an empty last word of a text comes before the next text
        first = (order >= len(gaps))
        start, stop = starts[order], np.sort(np.concatenate((gaps, end)), kind="stable")
        padded = np.concatenate((data, np.zeros(KEY_BYTES, np.uint8)))
        kind = np.where(first, 0, padded[np.maximum(start - 1, 0)])
        size = stop - start
        loads = np.ndarray(len(data) + KEY_BYTES - 7, "<u8", padded.data, strides=(1,))
        keys = [loads[np.minimum(start + 8 * i, len(data))] & _KEEP[np.clip(size - 8 * i, 0, 8)] for i in range(KEY_BYTES // 8)]
        about = kind.astype(np.uint64) | (size.astype(np.uint64) << np.uint64(8))
        one = mix(mix(mix(keys[0] + about) + keys[1]) + keys[2])
        two = mix(keys[2] * np.uint64(0x9E3779B97F4A7C15) + mix(keys[1] ^ mix(keys[0] * np.uint64(3) + about)))
        wide = np.flatnonzero(size > KEY_BYTES)
        one[wide] = wide  # never equal to one another
        by = np.argsort(one)
        sorted_one, sorted_two = one[by], two[by]
        new = np.ones(len(by), bool)
        new[1:] = (sorted_one[1:] != sorted_one[:-1]) | (sorted_two[1:] != sorted_two[:-1]) | (size[by][1:] > KEY_BYTES)
        some = by[new]  # one occurrence of each distinct piece
        raw = data.tobytes()
        space = {0: "", 0x20: " ", 0x0A: "\n"}

        def piece(i: np.ndarray) -> list[str]:
            x = some[i]
            return [space[k] + raw[a:b].decode() for k, a, b in
                    zip(kind[x].tolist(), start[x].tolist(), stop[x].tolist(), strict=True)]

        row = np.empty(len(by), np.int64)
        row[by] = self._rows(one[some], two[some], size[some] > KEY_BYTES, piece)[np.cumsum(new) - 1]
        lengths = self.lengths[row]
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.starts[row] - before, lengths) + np.arange(lengths.sum())
        return self.pool[at], np.add.reduceat(lengths, np.flatnonzero(first))

    def encode(self, column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        if not len(column):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        blank = _BLANK[data]
        odd = _ODD[data]
        odd[1:] |= blank[1:] & blank[:-1]
        for a, b in _ODD_PAIRS:
            odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
        raw = data.tobytes()
        for token in self.added:  # texts that hold an added token's string
            found = raw.find(token)
            while found >= 0:
                odd[found] = True
                found = raw.find(token, found + 1)
        special = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)
        regular = np.setdiff1d(np.arange(len(column)), special)
        counts = np.zeros(len(column), np.int64)
        ids = np.empty(0, np.int32)
        if len(regular):
            ids, counts[regular] = self._regular(data, offsets[regular], offsets[regular + 1])
        if not len(special):
            return ids, counts
        whole = self._whole([column[int(i)].as_py() for i in special])
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(column)
        ends = np.cumsum(counts[regular])
        for i, end in zip(regular, ends, strict=True):
            parts[i] = ids[end - counts[i]:end]
        for i, w in zip(special, whole, strict=True):
            parts[i], counts[i] = np.array(w, np.int32), len(w)
        return np.concatenate(parts), counts


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_tokens(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None, end_id: int = END_ID,
                 order_by: Sequence[str | Column] = ("doc_id",)) -> str:
    """Write the token files of ``docs`` in the order of ``order_by`` and return their folder (``path``, or a new
    folder under the shared checkpoint folder)."""
    from pyspark import TaskContext

    spark = docs.sparkSession
    prepare(spark)
    path = path or scratch_path(spark, "tokens")
    vocabulary = tokenizer_path or default_tokenizer()
    order = [f"order_{i}" for i in range(len(order_by))] + ["tie"]
    rows = docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(a) for c, a in zip(order_by, order, strict=False)],
                       F.xxhash64("text").alias("tie"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocabulary).encode
        file_no, at, row = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            values, counts = encode_texts(batch.column("text"))
            n, m = counts + 1, len(counts)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                           pa.array(np.insert(values, np.cumsum(counts), end_id), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, file_no), pa.int32()), pa.array(np.arange(row, row + m), pa.int64()),
                 batch.column("doc_id"), pa.array(at + ends - n, pa.int64()), pa.array(n, pa.int64()), ids],
                ["file_no", "row_no", "doc_id", "start_in_file", "n_tokens", "ids"])
            at, row = at + int(ends[-1]) if m else at, row + m

    (rows.mapInArrow(encode, FILE_SCHEMA).write.mode("overwrite")
     .option("orc.compress", "ZSTD").option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_STRIDE))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))
    return path


def read_tokens(spark, path: str) -> DataFrame:
    """The rows of the token files: doc_id, ``start`` (tokens before the document in all files), n_tokens, ids.
    A filter on ``doc_id`` prunes files, stripes and row groups by their indexes and Bloom filters."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    per_file = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n")).collect()  # one row per file
    offsets, at = [], 0
    for r in sorted(per_file, key=lambda r: r["file_no"]):
        offsets.append((r["file_no"], at))
        at += r["n"]
    before = spark.createDataFrame(offsets, "file_no int, before long")
    return (rows.join(F.broadcast(before), "file_no")
            .select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids"))


def lookup(spark, path: str, doc_id: int) -> DataFrame:
    """The token row of one document, found through the files' indexes."""
    return spark.read.schema(FILE_SCHEMA).orc(path).filter(F.col("doc_id") == doc_id)


def token_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            column = batch.column("ids")
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            cuts = column.offsets.to_numpy(zero_copy_only=False)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                crcs.append(zlib.crc32(values[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
