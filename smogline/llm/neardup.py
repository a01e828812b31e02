"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles; its sketch is the ``k`` smallest. Equal
sets are one class from the start, so exact copies never meet each other again.

1. Inverted lists: a retained value that two or more classes hold is a list. Two classes at the threshold
   share at least ``least_overlap`` retained values (certain for sets up to k, else up to a chance below 1e-8),
   so it is enough that each class enters the lists of its rarest values, as many as leave fewer than that
   overlap out (prefix filter). Classes that share only a few very common lines enter no common list.
2. Every list links its members to its smallest member; the pairs pass the size bound and the union-sketch
   estimate, and exact Jaccard on the full sets decides. This joins almost every group in linear work.
3. What is left are pairs of one list whose members are still in different components. Lists are cut into
   blocks of bounded length, members of a list's largest component meet only the others, and a task compares two
   blocks by matrix products: first on retained values (the pair
   must reach the least overlap, and belong to this list: the first one it shares), then, for members that
   still have such a partner, on full sets. Only links leave the task, never pairs, and no list is one task.

Links feed distributed connected components. Only class representatives move; texts are read again only for
classes in lists.

Defined cases: texts without words (null, empty, white space) have n_shingles 0 and are their own component;
fewer words than a shingle are one shingle; rows that share an id are one document with several texts: they share a
component, and so does what any of them reaches; rows without an id take part, and carry the smallest id reached; long
texts are hashed in pieces, and their sets fit a task's memory; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import groups_for, prepare, texts_of, written
from smogline.llm.components import components
from smogline.llm.hashing import WORD_BASES, mix, slices, window_hashes, word_hashes

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
SKETCH = 64
#: Standard deviations by which an estimate may lie under the threshold.
SLACK = 6.35
#: Members of one block of a list.
BLOCK = 1024

SIGNATURE = "doc_id long, n_shingles long, key1 long, key2 long, sketch array<long>"


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    words, counts = word_hashes([t.lower() for t in texts])  # bytes.lower() changes A-Z only
    hashes, _, at = window_hashes(words, counts, shingle)
    ends = np.cumsum(counts)
    cuts = np.searchsorted(at, np.concatenate(([0], ends)))
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    whole = mix(slices(words, WORD_BASES[0], (ends - counts)[short], ends[short])) if len(short) else []
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for i, h in zip(short, whole, strict=True):
        sets[i] = np.array([h], np.uint64)
    return sets


def least_overlap(k: int, percent: int = PERCENT) -> int:
    """Retained values that two large sets at the threshold share, but for a chance below 1e-8."""
    p = percent / 100
    return max(1, math.floor(k * p - SLACK * math.sqrt(k * p * (1 - p))))


def least_estimate(k: int, percent: int = PERCENT) -> float:
    return least_overlap(k, percent) / k


def union_estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Jaccard estimate from two sketches: the share of the union's k smallest values that both hold."""
    union = np.union1d(a, b)[:k]
    return np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean() if len(union) else 0.0


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, k: int = SKETCH, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the whole set, and the sketch (ascending as unsigned values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(texts_of(batch), shingle)
            with np.errstate(over="ignore"):
                keys = [[mix(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64) for s in sets]
                        for c in (0x8BB84B93962EACC9, 0x2D358DCCAA6C78A5)]
            sizes = np.array([min(k, len(s)) for s in sets], np.int64)
            values = np.concatenate([s[:k] for s in sets]).view(np.int64) if len(sets) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                          pa.array(values, pa.int64()))],
                ["doc_id", "n_shingles", "key1", "key2", "sketch"])

    return docs.mapInArrow(run, SIGNATURE)


def inverted_lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, cid, n, prefix, held): the lists each class enters; ``held`` are its shared retained values from
    rare to common, of which the first ``prefix`` are its lists."""
    values = classes.select("cid", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    least = F.least(F.lit(least_overlap(k, percent)), F.ceil(F.col("n") * percent / 100)).cast("int")
    mine = (values.join(shared, "value").groupBy("cid", "n", "m")
            .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held")))
    mine = mine.select("cid", "n", F.transform("held", lambda x: x["value"]).alias("held"),
                       # values nobody else holds come first in the order and use up the prefix
                       (F.col("m") - least + 1 - (F.col("m") - F.size("held"))).alias("prefix"))
    return (mine.filter("prefix > 0").withColumn("prefix", F.least("prefix", F.size("held")))
            .withColumn("value", F.explode(F.slice("held", F.lit(1), F.col("prefix")))))


def star_links(lists: DataFrame, sketches: DataFrame, texts: DataFrame, k: int, percent: int, shingle: int) -> DataFrame:
    """Links (u, v) between the smallest member of a list and its other members."""
    first = lists.groupBy("value").agg(F.min("cid").alias("a"), F.min("n").alias("least_n"))
    pairs = (lists.join(first, "value").filter("cid <> a").select("a", F.col("cid").alias("b")).distinct())
    side = lambda c: sketches.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    floor = least_estimate(k, percent)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s_a, s_b = (batch.column(c).to_pylist() for c in ("s_a", "s_b"))
            keep = [union_estimate(np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64), k)
                    >= floor for x, y in zip(s_a, s_b, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    near = sized.mapInArrow(estimate, "a long, b long")
    side = lambda c: texts.select(F.col("cid").alias(c), F.col("text").alias(f"t_{c}"))
    full = near.join(side("a"), "a").join(side("b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (shingle_sets(texts_of(batch, c), shingle) for c in ("t_a", "t_b"))
            keep = [linked(x, y, percent) for x, y in zip(a, b, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return full.mapInArrow(verify, "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _incidence(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    rows_a, rows_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    keep_a, keep_b = np.isin(a, common), np.isin(b, common)
    col_a, col_b = np.searchsorted(common, a[keep_a]), np.searchsorted(common, b[keep_b])
    rows_a, rows_b = rows_a[keep_a], rows_b[keep_b]
    for at in range(0, len(common), 4096):  # bounded width of the dense matrices
        x, y = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        for m, rows, cols in ((x, rows_a, col_a), (y, rows_b, col_b)):
            own = (cols >= at) & (cols < at + 4096)
            m[rows[own], cols[own] - at] = 1
        out += x @ y.T
    return out


def block_sizes(rooted: DataFrame, block: int) -> DataFrame:
    """Per list with two or more components: its largest component, whether it is short (one block), the blocks of
    its other members, the pieces of the largest, and how many rows ``block_pairs`` makes of it."""
    sizes = (rooted.groupBy("value", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("value")
             .agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("roots"))
             .filter("roots > 1")
             .select("value", F.col("top.root").alias("largest"), (F.col("members") <= 2 * block).alias("short"),
                     F.col("top.n").alias("most"), (F.col("members") - F.col("top.n")).alias("others"),
                     F.ceil((F.col("members") - F.col("top.n")) / block).alias("many"),
                     F.ceil(F.col("top.n") / block).alias("rest")))
    sizes = sizes.select("value", "largest", "short", "most", "others",
                         F.when(F.col("short"), 1).otherwise(F.col("many")).cast("int").alias("blocks"),
                         F.when(F.col("short"), 0).otherwise(F.col("rest")).cast("int").alias("pieces"))
    made = F.col("most") * F.col("blocks") + F.col("others") * (F.col("blocks") + F.col("pieces"))
    return sizes.select("value", "largest", "short", "blocks", "pieces", made.alias("made"))


def block_pairs(rooted: DataFrame, sizes: DataFrame) -> DataFrame:
    """The members (value, i, j, side, cid, root, n, held, prefix) of the block pairs to compare, one row per member
    and pair, from the ``block_sizes`` of the lists.

    Only lists with two or more components count. Members of a list's largest component needn't meet each other:
    the others, cut into blocks, meet one another and the pieces of the largest. A short list is one block.
    """
    sizes = sizes.drop("made")
    large = (F.col("root") == F.col("largest")) & ~F.col("short")
    own = F.pmod(F.xxhash64("cid"), F.when(large, F.col("pieces")).otherwise(F.col("blocks"))).cast("int")

    def pair(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    def upto(n, fn):
        return F.transform(F.filter(F.sequence(F.lit(0), F.col(n)), lambda x: x < F.col(n)), fn)

    o = F.col("own")
    others = F.concat(upto("blocks", lambda x: pair(F.least(o, x), F.greatest(o, x), o > x)),
                      upto("pieces", lambda p: pair(o, F.col("blocks") + p, F.lit(0))))
    largest = upto("blocks", lambda x: pair(x, F.col("blocks") + o, F.lit(1)))
    return (rooted.join(sizes, "value").withColumn("own", own)
            .withColumn("at", F.explode(F.when(large, largest).otherwise(others)))
            .select("value", "at.i", "at.j", "at.side", "cid", "root", "n", "held", "prefix"))


def rest_members(blocks: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """The members (value, i, j, side, cid, root, held, prefix) of block pairs that still have a partner: in
    another component, of fitting size, with the least overlap of retained values, and first met in this list."""
    floor = least_overlap(k, percent)

    def run(rows):
        rows = rows.sort_by([("value", "ascending"), ("i", "ascending"), ("j", "ascending")])
        value, i, j = (rows.column(c).to_numpy() for c in ("value", "i", "j"))
        side, cid, root, n, prefix = (rows.column(c).to_numpy() for c in ("side", "cid", "root", "n", "prefix"))
        flat = rows.column("held").combine_chunks()
        held, off = flat.values.to_numpy(), flat.offsets.to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]),
                                              [True])))
        keep = np.zeros(len(value), bool)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.arange(a, b)
            x = at[side[a:b] == 0]
            y = x if i[a] == j[a] else at[side[a:b] == 1]
            if not len(x) or not len(y) or len(np.unique(root[np.concatenate((x, y))])) < 2:
                continue
            fit = 100 * n[x][:, None] >= percent * n[y][None, :]
            fit &= 100 * n[y][None, :] >= percent * n[x][:, None]
            fit &= root[x][:, None] != root[y][None, :]
            if not fit.any():
                continue
            sets = {m: held[off[m]:off[m + 1]] for m in np.concatenate((x, y)).tolist()}
            least = np.minimum(floor, -(-n * percent // 100))
            fit &= _incidence([sets[m] for m in x], [sets[m] for m in y]) >= np.maximum.outer(least[x], least[y])
            if not fit.any():
                continue
            # the pair belongs to the first list it shares: no common value before this one in either's order
            before = {m: s[:int(np.flatnonzero(s == value[a])[0])] for m, s in sets.items()}
            fit &= _incidence([before[m] for m in x], [before[m] for m in y]) == 0
            keep[x] |= fit.any(1)
            keep[y] |= fit.any(0)
        return rows.filter(pa.array(keep)).select(["value", "i", "j", "side", "cid", "root", "n"])

    bucket = F.pmod(F.xxhash64("value", "i", "j"), F.lit(buckets)).cast("int")
    return (blocks.withColumn("bucket", bucket).repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(run, "value long, i int, j int, side int, cid long, root long, n long"))


def rest_links(members: DataFrame, texts: DataFrame, percent: int, shingle: int, buckets: int) -> DataFrame:
    """Links (u, v) between members of a block pair in different components, by exact Jaccard of full sets."""
    full = members.join(texts, "cid")

    def run(rows):
        rows = rows.sort_by([("value", "ascending"), ("i", "ascending"), ("j", "ascending")])
        value, i, j, side, cid, root = (rows.column(c).to_numpy() for c in ("value", "i", "j", "side", "cid", "root"))
        sets = [s for b in rows.to_batches() for s in shingle_sets(texts_of(b), shingle)]
        size = np.array([len(s) for s in sets])
        cuts = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]),
                                              [True])))
        u, v = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.arange(a, b)
            x = at[side[a:b] == 0]
            y = x if i[a] == j[a] else at[side[a:b] == 1]
            if not len(x) or not len(y):
                continue
            both = _incidence([sets[m] for m in x], [sets[m] for m in y])
            link = 100 * both >= percent * (np.add.outer(size[x], size[y]) - both)
            link &= root[x][:, None] != root[y][None, :]
            p, q = np.nonzero(link)
            u.append(root[x][p])
            v.append(root[y][q])
        u, v = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (u, v))
        pairs = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v))), axis=1)  # components, not members
        return pa.table({"u": pa.array(pairs[0], pa.int64()), "v": pa.array(pairs[1], pa.int64())})

    bucket = F.pmod(F.xxhash64("value", "i", "j"), F.lit(buckets)).cast("int")
    return (full.withColumn("bucket", bucket).repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(run, "u long, v long"))


def near_duplicates(docs: DataFrame, k: int = SKETCH, percent: int = PERCENT, shingle: int = SHINGLE,
                    block: int = BLOCK) -> DataFrame:
    """Per document row: n_shingles, component_id (smallest reachable doc_id) and kept."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed, _ = written(signatures(rows, k, shingle), "signatures")
    classes, _ = written(signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "key1", "key2")
                         .agg(F.min("doc_id").alias("cid"), F.first("sketch").alias("sketch"))
                         .withColumnRenamed("n_shingles", "n"), "classes")
    lists, _ = written(inverted_lists(classes.select("cid", "n", "sketch"), k, percent), "lists")
    needed = lists.select("cid").distinct()
    texts, _ = written(rows.withColumnRenamed("doc_id", "cid").join(needed, "cid", "left_semi"), "texts")
    sketches = classes.join(needed, "cid", "left_semi").select("cid", "n", "sketch")
    links, _ = written(star_links(lists, sketches, texts, k, percent, shingle), "links")
    found = components(links)

    rooted = (lists.join(found.withColumnRenamed("node", "cid"), "cid", "left")
              .withColumn("root", F.coalesce("root", "cid")))
    sizes, _ = written(block_sizes(rooted, block), "sizes")
    n_rows = sizes.agg(F.sum("made")).first()[0] or 0
    members, _ = written(rest_members(block_pairs(rooted, sizes), k, percent, groups_for(spark, n_rows, 20_000)), "members")
    more = rest_links(members, texts, percent, shingle, groups_for(spark, members.count(), 1000))
    bridges, _ = written(more, "bridges")
    repeated, same = repeated_ids(signed, classes)
    edges = found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(bridges).unionByName(same)
    roots = components(edges)

    by_class = (classes.select(F.col("n").alias("n_shingles"), "key1", "key2", "cid")
                .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
                .select("n_shingles", "key1", "key2", F.coalesce("root", "cid").alias("root")))
    joined = signed.select("doc_id", "n_shingles", "key1", "key2").join(by_class, ["n_shingles", "key1", "key2"], "left")
    out = joined.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    if not repeated.isEmpty():  # also an empty text shares the component of its id
        own = out.join(repeated, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
        out = (out.join(own, "doc_id", "left")
               .select("doc_id", "n_shingles", F.coalesce("of_id", "component_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def repeated_ids(signed: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the ids with different texts, edges (u, v) from each of their classes to the smallest one)."""
    key = F.struct("n_shingles", "key1", "key2")
    ids, _ = written(signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
                     .filter("low <> high").select("doc_id"), "repeated")
    of = classes.select(F.col("n").alias("n_shingles"), "key1", "key2", "cid")
    own = signed.join(ids, "doc_id").join(of, ["n_shingles", "key1", "key2"]).select("doc_id", "cid").distinct()
    least = own.groupBy("doc_id").agg(F.min("cid").alias("v"))
    return ids, own.join(least, "doc_id").filter("cid <> v").select(F.col("cid").alias("u"), "v").distinct()
