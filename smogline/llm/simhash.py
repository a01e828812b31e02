"""SimHash near-dedup by segment-popcount embedding and a grid range-join.

A text's fingerprint has bit b set where over half of its shingles' XXH64 values (seed 42) have it set. Equal fingerprints
are one class from the start. Two classes are linked when their fingerprints differ in at most ``DISTANCE`` bits.

Embedding: the 64 bits are cut into segments of two; the bit counts of the 32 segments are a point of a grid with
coordinates 0 to 2. A differing bit changes one coordinate by at most one, so the Manhattan distance of two points never
exceeds the Hamming distance. A point is held as 64 bits with each segment's set bits moved to its low end (0, 1, 3):
the Manhattan distance is then the number of differing bits of two points.

Range join: of two points at Manhattan distance 3 or less, one half (16 coordinates) is at distance 1 or less. So
each class enters, for either half, its own cell (the half's coordinates) and as a probe the up to 16 cells one
step up in one coordinate; every linked pair meets in a cell, as two owners or as owner and probe. Pairs in a cell are
tested first by the Manhattan bound on all 32 coordinates, then exactly by differing bits.

Cells are dealt by hash to buckets, one task joins a bucket's cells by array operations in bounded chunks, and returns a
spanning forest of the links it finds, never the pairs. Cells with more than ``HOT`` members are cut into blocks that
meet block against block in different tasks. Forests feed distributed connected components.

Defined cases: texts without words (null, empty, white space) have fingerprint zero and are linked like any other; fewer
words than a shingle are one shingle; rows that share an id share a component, and so does what either reaches; rows
with a null id take part and carry the smallest id reached (null if there is none); long texts are hashed piece by
piece; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import groups_for, prepare, texts_of, written
from smogline.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Bytes of a text split into words at a time, and hashes whose bits are counted at a time.
PIECE = 1 << 22
HASHES = 1 << 18
#: Rows of a cell from which it is cut, the rows of one of its blocks, and the rows of a bucket.
HOT = 16_384
BLOCK = 4096
BUCKET = 200_000
#: Hot cells that may be broadcast, and the number of classes of fingerprints that can be hot.
BROADCAST_CELLS = 100_000
HOT_CLASSES = 1000
#: Pairs tested at a time.
CHUNK = 1 << 21

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOW = np.uint64(0x5555555555555555)

SIGNED = "doc_id long, fp long"
MEMBERS = "cell long, fp long, probe boolean"


def _word_runs(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words of a text in runs that overlap by shingle - 1 words."""
    at, carried = 0, []
    while True:
        stop = min(at + PIECE, len(text))
        if stop < len(text):  # a run ends between words
            space = _SPACE.search(text, stop)
            stop = space.start() if space else len(text)
        words = carried + text[at:stop].lower().split()  # bytes: A-Z and the six ASCII blanks only
        yield words
        if stop == len(text):
            return
        carried, at = words[len(words) - min(len(words), shingle - 1):], stop


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> Iterator[list[int]]:
    """The unsigned hashes of a text's shingles, repeats included, run by run."""
    digest, seen = xxhash.xxh64_intdigest, False
    words: list[bytes] = []
    for words in _word_runs(text, shingle):
        if len(words) >= shingle:
            seen = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))[:len(words) - shingle + 1].tolist()
            yield [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)]
    if words and not seen:
        yield [digest(b" ".join(words), SEED)]


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text (uint64)."""
    ones, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    owners: list[int] = []
    parts: list[list[int]] = []
    held = 0

    def count() -> None:
        nonlocal held
        if parts:
            sizes = [len(p) for p in parts]
            values = np.concatenate([np.array(p, "<u8") for p in parts])
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            np.add.at(ones, owners, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64))
            np.add.at(totals, owners, sizes)
            owners.clear()
            parts.clear()
            held = 0

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, shingle):
            owners.append(i)
            parts.append(hashes)
            held += len(hashes)
            if held >= HASHES:
                count()
    count()
    return np.packbits(2 * ones > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()


def embed(fp: np.ndarray) -> np.ndarray:
    """Segment bit counts as 64 bits: in each segment of two as many low bits as the segment has set."""
    low, high = fp & _LOW, (fp >> np.uint64(1)) & _LOW
    return (low | high) | ((low & high) << np.uint64(1))


def cell_members(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, number of the fingerprint, probe?) of the cells every fingerprint enters."""
    point = embed(fp)
    cells, who, probe = [], [], []
    for half in range(2):
        key = ((point >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)) | np.uint64(half << 32)
        cells.append(key)
        who.append(np.arange(len(fp)))
        probe.append(np.zeros(len(fp), bool))
        for i in range(0, 32, 2):  # one step up: 0 to 1, 1 to 2
            segment = (key >> np.uint64(i)) & np.uint64(3)
            up = np.flatnonzero(segment < 3)
            cells.append(key[up] | ((segment[up] + np.uint64(1)) << np.uint64(i)))
            who.append(up)
            probe.append(np.ones(len(up), bool))
    return np.concatenate(cells), np.concatenate(who), np.concatenate(probe)


def contract(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of every i with those of j; ``labels`` points to the smallest number of each."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels[:] = further


def forest(groups: list[np.ndarray], fp: np.ndarray, right: np.ndarray, inner: np.ndarray, distance: int = DISTANCE,
           chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (fingerprint, root) of the links inside groups (rows equal in all of ``groups``): left rows
    of a group meet its right rows and, if ``inner``, each other."""
    order = np.lexsort((right, *groups))
    fp, right, inner = fp[order], right[order], inner[order]
    new = np.zeros(len(fp) + 1, bool)
    new[[0, len(fp)]] = True
    for g in groups:
        g = g[order]
        new[1:-1] |= g[1:] != g[:-1]
    of, starts = np.cumsum(new[:-1]) - 1, np.flatnonzero(new)
    left = np.flatnonzero(~right)
    first_right = starts[:-1] + np.bincount(of[left], minlength=len(starts) - 1)
    begin = np.where(inner[left], left + 1, first_right[of[left]])
    counts = starts[1:][of[left]] - begin
    left, begin, counts = (x[counts > 0] for x in (left, begin, counts))
    nodes, node = np.unique(fp, return_inverse=True)
    labels, point = np.arange(len(nodes)), embed(fp)
    done, at = np.cumsum(counts), 0
    while at < len(left):
        upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + chunk, "right")))
        n = counts[at:upto]
        i = np.repeat(left[at:upto], n)
        j = np.repeat(begin[at:upto] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        near = np.bitwise_count(point[i] ^ point[j]) <= distance  # the Manhattan bound
        i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        contract(labels, node[i[near]], node[j[near]])
        at = upto
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def hot_blocks(members: DataFrame, hot: DataFrame, block: int) -> DataFrame:
    """(cell, i, j, fp, right, inner) of the block pairs of cells in ``hot`` (cell, owners, probes): every block of owners
    meets itself, the other blocks of owners and all blocks of probes."""
    sized = hot.select("cell", F.ceil(F.col("owners") / block).cast("int").alias("o"),
                       F.ceil(F.col("probes") / block).cast("int").alias("p"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("probe"), F.col("p")).otherwise(F.col("o"))).cast("int")

    def pair(i, j, right, inner):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), right.alias("right"), inner.alias("inner"))

    def upto(n, fn):
        return F.transform(F.filter(F.sequence(F.lit(0), F.col(n)), lambda x: x < F.col(n)), fn)

    b = F.col("b")
    owner = F.concat(upto("o", lambda x: pair(F.least(b, x), F.greatest(b, x), b > x, b == x)),
                     upto("p", lambda x: pair(b, F.col("o") + x, F.lit(False), F.lit(False))))
    prober = upto("o", lambda x: pair(x, F.col("o") + b, F.lit(True), F.lit(False)))
    return (members.join(sized, "cell").withColumn("b", own)
            .withColumn("at", F.explode(F.when(F.col("probe"), prober).otherwise(owner)))
            .select("cell", "at.i", "at.j", "fp", "at.right", "at.inner"))


def links(classes: DataFrame, distance: int = DISTANCE, hot_rows: int = HOT, block: int = BLOCK,
          bucket_rows: int = BUCKET) -> DataFrame:
    """Edges (u, v) of fingerprints that span every component of the links between different fingerprints (``fp``)."""
    if distance > 3:
        raise ValueError("the cells cover distances up to 3")
    spark = classes.sparkSession

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            cell, who, probe = cell_members(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp[who]), pa.array(probe)],
                                             ["cell", "fp", "probe"])

    members = classes.select("fp").mapInArrow(enter, MEMBERS)
    counts = members.groupBy("cell").agg(F.count_if(~F.col("probe")).alias("owners"), F.count_if("probe").alias("probes"))
    hot, _ = written(counts.filter("owners > 0").filter(F.col("owners") + F.col("probes") > hot_rows), "hot-cells")
    blocks = lambda c: F.ceil(F.col(c) / block)
    n_hot, made = hot.agg(F.count(F.lit(1)), F.sum(F.col("owners") * (blocks("owners") + blocks("probes"))
                                                   + F.col("probes") * blocks("owners"))).first()
    rows = members.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", F.col("probe").alias("right"),
                          F.lit(True).alias("inner"))
    if n_hot:
        small = F.broadcast(hot) if n_hot <= BROADCAST_CELLS else hot
        rows = rows.join(small, "cell", "left_anti").unionByName(hot_blocks(members, small, block))
    buckets = groups_for(spark, 34 * classes.count() + int(made or 0), bucket_rows)

    def run(table: pa.Table) -> pa.Table:
        cell, i, j, fp = (table.column(c).to_numpy() for c in ("cell", "i", "j", "fp"))
        right, inner = (table.column(c).to_numpy() for c in ("right", "inner"))
        u, v = forest([cell, i, j], fp.view(np.uint64), right, inner, distance)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    bucket = F.pmod(F.xxhash64("cell", "i", "j"), F.lit(buckets)).cast("int")
    return (rows.withColumn("bucket", bucket).repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(run, "u long, v long"))


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints(texts_of(batch), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNED)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, hot_rows: int = HOT,
                    block: int = BLOCK) -> DataFrame:
    """Per document row: fingerprint (16 hex digits) and component_id (the smallest reachable doc_id)."""
    prepare(docs.sparkSession)
    signed, _ = written(signatures(docs, shingle), "simhash")
    classes, _ = written(signed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    edges = links(classes, distance, hot_rows, block)
    several = (signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("v"), F.max("fp").alias("most"))
               .filter("v < most"))  # an id with texts of different fingerprints joins their classes
    same = signed.join(several, "doc_id").select(F.col("fp").alias("u"), "v").filter("u <> v").distinct()
    roots, _ = written(components(edges.unionByName(same)), "roots")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found, _ = written(rooted.join(smallest, "root").select("fp", "n", "component_id"), "components")
    total = signed.count()
    hot = F.broadcast(found.filter(F.col("n") > max(HOT, total // HOT_CLASSES)).select("fp", F.lit(True).alias("hot"),
                                                                                      F.col("component_id").alias("of_hot")))
    rows = signed.join(hot, "fp", "left")  # at most HOT_CLASSES classes are that large: their rows stay where they lie
    rest = rows.filter("hot IS NULL").join(found.select("fp", "component_id"), "fp")
    rows = (rows.filter("hot").select("doc_id", "fp", F.col("of_hot").alias("component_id"))
            .unionByName(rest.select("doc_id", "fp", "component_id")))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
