"""Mutual information by nearest neighbours (Kraskov's estimator), without comparing all pairs.

Both values are divided by their deviation. With r the distance (the larger of the two differences) from a row to its k-th
nearest other one, and n_x, n_y the rows within r on either axis alone (the row itself included),

    MI = psi(n) + psi(k) - mean(psi(n_x) + psi(n_y)), and 0 if that is negative.

k-th distances: the plane is cut into square cells; a row meets the rows of its cell and of the ring around it. The distance
is exact if it doesn't reach beyond the ring. Rows for which it does go on to cells eight times as wide. Cells with more than
``FULL`` rows are first cut into cells an eighth as wide, so that a spot that holds a third of all rows costs no more than others;
ring members beyond ``BLOCK`` are dealt to several tasks, whose k best are merged. Cells are dealt to buckets by hash, and one
task joins a bucket's cells by array operations in bounded chunks.

Counts on the axes: rows and the two ends of every interval are put in one order by range partitions and prefix sums
(``running_counts``), so no axis is ever ordered in one task.

Equal values need a tie-break: ``jitter`` is added to both scaled values (default: a hash of the keys, of size 1e-10).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.columns import round_half
from smogline.operators.profile import running_counts
from smogline.session import ship_package, stored

NEIGHBOURS = 3
#: Rows of a cell aimed at, rows from which a cell is cut smaller, ring members of one block, rows of a bucket, pairs at a time.
PER_CELL, FULL, BLOCK, BUCKET, CHUNK = 8, 512, 4096, 100_000, 1 << 21
#: Ratio of the widths of two levels, and the finest level.
STEP, FINEST = 8, -14
#: Radii are taken smaller by this share, so that the k-th neighbour itself isn't counted on its axis.
INSIDE = 1e-12

POINT = "feature string, id long, x double, y double"


def scaled_points(df: DataFrame, features: Sequence[str], target: str, jitter: Column) -> DataFrame:
    """(feature, id, x, y): complete pairs, scaled by their deviations (rounded to 6 digits), as a written table."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("a"), F.col(target).cast("double").alias("b")) for c in features]
    long = stored(df.select(jitter.alias("jitter"), F.inline(F.array(*pairs))).filter("a IS NOT NULL AND b IS NOT NULL")
                  .withColumn("id", F.monotonically_increasing_id()), "pairs")
    spread = long.groupBy("feature").agg(*[round_half(F.stddev_pop(c), 6).alias(f"s{c}") for c in "ab"])
    spread = stored(spread, "spreads")  # one row a feature
    unit = lambda c: F.when(F.col(f"s{c}") > 0, F.col(c) / F.col(f"s{c}")).otherwise(F.lit(0.0)) + F.col("jitter")
    return stored(long.join(spread, "feature").select("feature", "id", unit("a").alias("x"), unit("b").alias("y")), "points")


def _cell(width: float) -> list[Column]:
    return [F.floor(F.col(c) / F.lit(width)).alias(f"c{c}") for c in "xy"]


def _nearest(table: pa.Table, width: float, k: int) -> pa.Table:
    """For the queries of some cells (rows with a block's members): how many members they met and their k least distances."""
    group = [table.column(c).to_numpy(zero_copy_only=False) for c in ("feature", "cx", "cy", "block")]
    _, names = np.unique(group[0].astype(str), return_inverse=True)
    member = table.column("member").to_numpy(zero_copy_only=False)
    order = np.lexsort((member, *group[:0:-1], names))
    ids, x, y = (table.column(c).to_numpy()[order] for c in ("id", "x", "y"))
    member = member[order]
    new = np.zeros(len(ids) + 1, bool)
    new[[0, -1]] = True
    for g in (names, *group[1:]):
        new[1:-1] |= g[order][1:] != g[order][:-1]
    starts, of = np.flatnonzero(new), np.cumsum(new[:-1]) - 1
    asks = np.flatnonzero(~member)
    first = starts[:-1] + np.bincount(of[asks], minlength=len(starts) - 1)
    begin, counts = first[of[asks]], starts[1:][of[asks]] - first[of[asks]]
    least, met = np.full((len(asks), k), np.inf), np.zeros(len(asks), np.int64)
    done, at = np.cumsum(counts), 0
    while at < len(asks):
        upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + CHUNK, "right")))
        n = counts[at:upto]
        q = np.repeat(np.arange(at, upto), n)
        j = np.repeat(begin[at:upto] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        other = ids[j] != ids[asks[q]]
        met[at:upto] = n
        q, j = q[other], j[other]
        d = np.maximum(np.abs(x[j] - x[asks[q]]), np.abs(y[j] - y[asks[q]]))
        by = np.lexsort((d, q))
        q, d = q[by], d[by]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        near = rank < k
        least[q[near], rank[near]] = d[near]
        at = upto
    names_of = table.column("feature").to_numpy(zero_copy_only=False)[order][asks]
    return pa.table({"feature": pa.array(names_of, pa.string()), "id": pa.array(ids[asks]), "met": pa.array(met),
                     "least": pa.array(least.tolist(), pa.list_(pa.float64()))})


def level_search(points: DataFrame, queries: DataFrame, sizes: DataFrame, width: float, k: int) -> DataFrame:
    """(feature, id, x, y, distance, exact) of the queries among the points of their cells and rings, as a written table."""
    asked = queries.select("feature", "id", "x", "y", *_cell(width))
    ring = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    members = (points.select("feature", "id", "x", "y", *_cell(width)).withColumn("dx", ring).withColumn("dy", ring)
               .select("feature", (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"), "id", "x", "y"))
    cell = ["feature", "cx", "cy"]
    members = stored(members.join(asked.select(*cell).distinct(), cell, "left_semi"), "ring-members")
    blocks = members.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cols = [*cell, "block", "id", "x", "y", "member"]
    own = members.join(blocks, cell).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long"))).withColumn("member", F.lit(True))
    asks = (asked.join(blocks, cell).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
            .withColumn("member", F.lit(False)))
    rows = own.select(*cols).unionByName(asks.select(*cols))
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * members.count() // BUCKET))
    found = (rows.withColumn("bucket", F.pmod(F.xxhash64(*cell, "block"), F.lit(parts)).cast("int")).repartition(parts, "bucket")
             .groupBy("bucket").applyInArrow(lambda t: _nearest(t, width, k), "feature string, id long, met long, least array<double>"))
    best = found.groupBy("feature", "id").agg(
        F.sum("met").alias("met"), F.element_at(F.array_sort(F.flatten(F.collect_list("least"))), k).alias("distance"))
    room = lambda c: F.least(F.col(c) - F.col(f"c{c}") * width, (F.col(f"c{c}") + 1) * width - F.col(c))
    reach = F.lit(width) + F.least(room("x"), room("y"))
    out = asked.join(best, ["feature", "id"]).join(sizes, "feature")
    return stored(out.select("feature", "id", "x", "y", "distance",
                             ((F.col("distance") <= reach) | (F.col("met") == F.col("n"))).alias("exact")), "distances")


def kth_distances(points: DataFrame, k: int = NEIGHBOURS, full: int = FULL) -> DataFrame:
    """(feature, id, x, y, distance): the exact distance to the k-th nearest other point of the same feature."""
    ship_package(points.sparkSession)
    sizes = stored(points.groupBy("feature").agg(F.count(F.lit(1)).alias("n")), "sizes")  # one row a feature
    most = sizes.agg(F.max("n")).first()[0] or 0
    base = 4.0 * (PER_CELL / max(most, 1)) ** 0.5
    width = lambda level: base * float(STEP) ** level
    level, rest, homes = 0, points, {}
    cell = ["feature", "cx", "cy"]
    while True:  # rows of crowded cells go down to smaller ones
        placed = rest.select("feature", "id", "x", "y", *_cell(width(level)))
        crowded = stored(placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > full), "crowded")
        if level == FINEST or crowded.isEmpty():
            homes[level] = rest
            break
        homes[level] = placed.join(crowded, cell, "left_anti")
        rest = stored(placed.join(crowded, cell, "left_semi").select("feature", "id", "x", "y"), "crowd")
        level -= 1
    done: list[DataFrame] = []
    waiting = None
    while True:  # and those whose neighbours lie beyond the ring go up to wider ones
        here = [q.select("feature", "id", "x", "y") for q in (homes.get(level), waiting) if q is not None and not q.isEmpty()]
        if here:
            found = level_search(points, reduce(DataFrame.unionByName, here), sizes, width(level), k)
            done.append(found.filter("exact"))
            waiting = found.filter("NOT exact")
        elif level >= 0:
            break
        level += 1
    if not done:
        return points.select("feature", "id", "x", "y", F.lit(None).cast("double").alias("distance")).limit(0)
    return reduce(DataFrame.unionByName, done).select("feature", "id", "x", "y", "distance")


def digamma(n: Column) -> Column:
    """psi of a whole number from 1 on: harmonic sums while small, then the asymptotic series."""
    gamma, small = 0.5772156649015329, 24
    sums = np.concatenate(([0.0], np.cumsum(1 / np.arange(1, small))))
    inverse = 1 / (n * n)
    series = F.log(n) - 0.5 / n - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252))
    table = F.array(*[F.lit(float(s) - gamma) for s in sums])
    return F.when(n <= small, F.element_at(table, F.least(n, F.lit(small)).cast("int"))).otherwise(series)


def axis_counts(distances: DataFrame) -> DataFrame:
    """(feature, id, n_x, n_y): rows closer than the distance on each axis, the row itself included."""
    inner = F.col("distance") * (1 - INSIDE)
    axes = F.inline(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("v")) for c in "xy"]))
    ends = distances.select("feature", "id", inner.alias("r"), axes).select(
        "feature", "axis", "id", (F.col("v") - F.col("r")).alias("low"), (F.col("v") + F.col("r")).alias("high"))
    ends = stored(ends, "intervals")
    points = distances.select("feature", axes).withColumn("c", F.lit(1))
    marks = [ends.select("feature", "axis", F.col(e).alias("v"), F.lit(0).alias("c")) for e in ("low", "high")]
    every = points.unionByName(marks[0]).unionByName(marks[1])
    key = ["feature", "axis"]
    ranked = running_counts(every.groupBy(*key, "v").agg(F.sum("c").alias("c")), key, "v", ["c"])
    ranked = stored(ranked.select(*key, "v", F.col("_before_c").alias("below"), (F.col("_before_c") + F.col("c")).alias("upto")), "axis-ranks")
    high = ranked.select(*key, F.col("v").alias("high"), "below")
    low = ranked.select(*key, F.col("v").alias("low"), "upto")
    inside = (ends.join(high, [*key, "high"]).join(low, [*key, "low"])
              .withColumn("inside", F.greatest(F.col("below") - F.col("upto"), F.lit(1))))  # radius 0: the row itself
    one = lambda c: F.max(F.when(F.col("axis") == c, F.col("inside"))).alias(f"n_{c}")
    return inside.groupBy("feature", "id").agg(one("x"), one("y"))


def neighbour_mutual_info(df: DataFrame, features: Sequence[str], target: str, k: int = NEIGHBOURS, keys: Sequence[str] = (),
                          jitter: Column | None = None, digits: int = 6, full: int = FULL) -> DataFrame:
    """Per feature: complete rows and mutual information with the target in nats (null with k rows or fewer)."""
    if jitter is None:
        jitter = (F.pmod(F.xxhash64(*(keys or df.columns)), F.lit(1 << 30)) / float(1 << 30) - 0.5) * 1e-10
    points = scaled_points(df, features, target, jitter)
    sizes = points.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    enough = points.join(sizes.filter(F.col("n") > k).select("feature"), "feature", "left_semi")
    counts = axis_counts(kth_distances(stored(enough, "enough"), k, full))
    mean = counts.groupBy("feature").agg(F.avg(digamma(F.col("n_x")) + digamma(F.col("n_y"))).alias("mean"))
    info = digamma(F.col("n")) + digamma(F.lit(k)) - F.col("mean")
    return sizes.join(mean, "feature", "left").select(
        "feature", "n", F.when(F.col("mean").isNotNull(), round_half(F.greatest(info, F.lit(0.0)), digits)).alias("mutual_info"))
