"""Mixing sources to target weights by Pfair scheduling.

Time runs in slots, one block of documents each. With weight w (the weights sum to 1), a source's i-th block may
not run before floor((i - 1) / w) and must run before ceil(i / w); earliest deadline first over the released blocks
meets all deadlines, so at every time each source is less than one block away from its share. Weights are the exact
fractions that the given numbers stand for, written as whole numbers over a common denominator of any length, so
releases and deadlines are never rounded, however many slots there are. When a source has no more blocks, the others
go on with their weights rescaled (no row is ever dropped), and the windows begin anew.

The driver only counts the sources. One task deals the slots: it reads nothing but these counts and keeps one entry
and one short array per source, and writes the slots of RUN blocks as one row. The documents get their place in their
source in Spark: a hash of the id spreads each source over many small buckets, bucket sizes are summed, and ranks
within a bucket complete the place; no source is ever one task.

Defined cases: a null source is a source of its own; sources without a weight (or with weight 0) come after all
others, in equal shares; the last block of a source may be shorter; equal ids are ordered by their text; texts are
only hashed, whatever their length; further columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import prepare, written

BLOCK_DOCS = 8
#: Blocks of a source whose slots are one row of the written schedule, and rows of one Arrow batch of it.
RUN = 128
RUN_ROWS = 512
#: Documents of a source in one bucket, about.
BUCKET_DOCS = 5000
#: Exponent of the default weights: between every source alike (0) and its size (1).
FLATTEN = 0.7


def whole_weights(weights: Mapping[str, float], period: int | None = None) -> dict[str, int]:
    """Weights as whole numbers in exactly the given proportions (0 stays 0; all 0: all alike). With a ``period``,
    rounded to whole numbers of at least 1 that sum to it (or to the number of sources, if larger)."""
    if period is None:
        exact = {s: max(Fraction(0), Fraction(w)) for s, w in weights.items()}
        if not any(exact.values()):
            return dict.fromkeys(weights, 1)
        scale = math.lcm(*(x.denominator for x in exact.values()))
        out = {s: int(x * scale) for s, x in exact.items()}
        common = math.gcd(*out.values())
        return {s: n // common for s, n in out.items()}
    period = max(period, len(weights))
    total = sum(max(0.0, w) for w in weights.values())
    if not total:
        weights, total = dict.fromkeys(weights, 1.0), float(len(weights))
    spare = period - len(weights)
    exact = {s: max(0.0, w) / total * spare for s, w in weights.items()}
    out = {s: 1 + math.floor(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in rest[:period - sum(out.values())]:
        out[s] += 1
    return out


def pfair_turns(weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot, without end: earliest deadline first over released blocks; ties go to the name first
    in the alphabet."""
    total = sum(weights.values())
    waiting = [(0, s, 1) for s in sorted(weights)]  # release, source, block
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-i * total // weights[s]), s, i))
        _, s, i = heapq.heappop(ready)
        yield s
        heapq.heappush(waiting, (i * total // weights[s], s, i + 1))
        slot += 1


def pfair_slots(weights: Mapping[str, int], slots: int | None = None) -> list[str]:
    """The sources of one period (or of the first ``slots``)."""
    return list(islice(pfair_turns(weights), sum(weights.values()) if slots is None else slots))


def active_weights(left: Mapping[str, int], weights: Mapping[str, int]) -> dict[str, int]:
    """The weights that hold while the sources of ``left`` have blocks: those without one wait for the others."""
    active = {s: weights[s] for s in left if weights[s]} or dict.fromkeys(left, 1)
    common = math.gcd(*active.values())
    return {s: w // common for s, w in active.items()}


def turns(blocks: Mapping[str, int], weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot until every source's blocks have one; memory is one entry per source."""
    left = {s: n for s, n in blocks.items() if n > 0}
    while left:
        for s in pfair_turns(active_weights(left, weights)):
            yield s
            left[s] -= 1
            if not left[s]:
                del left[s]
                break


@dataclass
class Phase:
    """``repeats`` periods of ``slots``, from slot ``start`` on; ``first`` is each source's first block in it."""

    start: int
    repeats: int
    slots: list[str]
    first: dict[str, int]


def schedule(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[Phase]:
    """``turns`` as phases, whole periods apart: a phase ends when a source is exhausted."""
    left, done, start, phases = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0, []
    while left:
        active = active_weights(left, weights)
        repeats = min(left[s] // w for s, w in active.items())
        if repeats:
            slots = pfair_slots(active)
        else:  # a part of a period, up to the last block of the first source to end
            slots, repeats, seen = [], 1, dict.fromkeys(active, 0)
            for s in pfair_turns(active):
                slots.append(s)
                seen[s] += 1
                if seen[s] == left[s]:
                    break
        phases.append(Phase(start, repeats, slots, {s: done[s] for s in active}))
        start += repeats * len(slots)
        for s, n in Counter(slots).items():
            done[s] += repeats * n
            left[s] -= repeats * n
        left = {s: n for s, n in left.items() if n > 0}
    return phases


def dealt(blocks: Mapping[str, int], weights: Mapping[str, int]) -> Iterator[pa.RecordBatch]:
    """The slots of ``turns``, RUN blocks of a source per row: name, run (from 0) and slots."""
    open_runs = {s: array("q") for s, n in blocks.items() if n > 0}
    runs = dict.fromkeys(open_runs, 0)
    rows: list[tuple[str, int, array]] = []

    def batch() -> pa.RecordBatch:
        names, numbers, slots = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(slots, pa.list_(pa.int64()))],
            ["name", "run", "slots"])

    for slot, s in enumerate(turns(blocks, weights)):
        open_runs[s].append(slot)
        if len(open_runs[s]) == RUN:
            rows.append((s, runs[s], open_runs[s]))
            open_runs[s], runs[s] = array("q"), runs[s] + 1
            if len(rows) == RUN_ROWS:
                yield batch()
                rows.clear()
    for s, own in open_runs.items():
        if own:
            rows.append((s, runs[s], own))
        if len(rows) == RUN_ROWS:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def flattened_weights(sizes: Mapping[str, int], exponent: float = FLATTEN) -> dict[str, float]:
    return {s: n ** exponent for s, n in sizes.items()}


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block_docs: int = BLOCK_DOCS,
        period: int | None = None, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """Per document row: doc_id, source, block (of its source, from 0), slot (of the schedule, from 0), place (in the
    block, from 0) and tie (a hash of the text). The mixture is the order by (slot, place). Without ``weights``, the
    sources' sizes to the power FLATTEN are the target; a ``period`` rounds the target to that many parts."""
    spark = docs.sparkSession
    prepare(spark)
    # a null source needs a name; it begins with a character that sorts before all others
    rows = docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("name"),
                       F.xxhash64("doc_id").alias("hash"), F.xxhash64("text").alias("tie"))
    buckets = 1
    sizes = {r["name"]: r["n"] for r in rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    while buckets * bucket_docs < max(sizes.values(), default=0):
        buckets *= 2
    given = flattened_weights(sizes) if weights is None else {s: weights.get(s[1:] if s else None, 0) or 0 for s in sizes}
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    whole = whole_weights(given, period)

    # places within a source: sizes of the buckets before, and the rank in the bucket
    placed, _ = written(rows.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int")), "places")
    before = (placed.groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("name").orderBy("bucket")
                                                    .rowsBetween(Window.unboundedPreceding, -1)))
              .select("name", "bucket", F.coalesce("before", F.lit(0)).alias("before")))
    by = Window.partitionBy("name", "bucket").orderBy("hash", "doc_id", "tie")
    ranked = (placed.withColumn("rank", F.row_number().over(by)).join(before, ["name", "bucket"])
              .withColumn("place", F.col("before") + F.col("rank") - 1)
              .withColumn("block", F.floor(F.col("place") / block_docs)))

    # a block's slot
    plan, _ = written(spark.range(1, numPartitions=1).mapInArrow(lambda _: dealt(blocks, whole),
                                                                 "name string, run long, slots array<long>"), "schedule")
    joined = ranked.withColumn("run", F.floor(F.col("block") / RUN)).join(plan, ["name", "run"])
    slot = F.element_at("slots", (F.col("block") % RUN + 1).cast("int"))
    return joined.select("doc_id", "source", F.col("block").cast("long").alias("block"), slot.cast("long").alias("slot"),
                         (F.col("place") % block_docs).cast("long").alias("place"), "tie")


def mixed_documents(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, sorted (across partitions too) in the order of the mixture."""
    order = mix(docs, weights, **options).groupBy("doc_id", "tie").agg(F.min(F.struct("slot", "place")).alias("turn"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("tie"))  # columns of any name
    there = rows["doc_id"].eqNullSafe(order["doc_id"]) & (rows["tie"] == order["tie"])
    return (rows.join(order, there).select("row", "turn", rows["doc_id"]).repartitionByRange("turn", "doc_id")
            .sortWithinPartitions("turn", "doc_id").select("row.*"))
