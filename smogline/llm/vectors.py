"""Integer vector blocks: vectors scaled, rounded down to integers and packed, for operators that pass over them often.

``integer_blocks`` writes one row per Arrow batch: the ids and the integers as one little-endian matrix in the
narrowest type that holds them, so that a pass reads and decodes little. ``summed`` adds up one array per task, in
Spark, so that the driver only ever receives one array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import prepare, written

BLOCKS = "ids array<long>, width int, data binary"
#: Scaled components from here on are no usable integers (sums of 64 of them must fit a long).
LARGEST = 2.0 ** 55


def vector_size(embeddings: DataFrame, vector: str = "embedding") -> int:
    """The most frequent number of components above 0 (the smaller on a tie); 0 without vectors."""
    found = (embeddings.select(F.size(vector).alias("dim")).filter("dim > 0").groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "dim").first())
    return found["dim"] if found else 0


def scaled_integers(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, floor(scale * c) as int64) of the vectors with ``dim`` usable components."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(flat.reshape(len(at), dim) * scale)
        fine = (np.abs(x) < LARGEST).all(1)
    return at[fine], x[fine].astype(np.int64)


def packed(x: np.ndarray) -> tuple[int, bytes]:
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return width, x.astype(f"<i{width}").tobytes()


def integer_blocks(embeddings: DataFrame, dim: int, scale: float, change: Callable[[np.ndarray], np.ndarray] | None = None,
                   vector: str = "embedding", name: str = "blocks") -> DataFrame:
    """The written blocks of all usable vectors (``change`` maps the integer matrix of a block first)."""
    spark = embeddings.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = scaled_integers(batch.column("vec"), dim, scale)
            if len(at):
                width, data = packed(change(x) if change else x)
                ids = batch.column("vec_id").take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), ids), pa.array([width], pa.int32()),
                     pa.array([data], pa.binary())], ["ids", "width", "data"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    return written(rows.mapInArrow(run, BLOCKS), name)[0]


def matrices(batch: pa.RecordBatch, dim: int) -> Iterator[np.ndarray]:
    """The integer matrix of each block of a batch."""
    for width, data in zip(batch.column("width").to_pylist(), batch.column("data"), strict=True):
        yield np.frombuffer(data.as_buffer(), f"<i{width}").reshape(-1, dim)


def id_lists(batch: pa.RecordBatch) -> list[pa.Array]:
    """The ids of each block of a batch."""
    return [v.values for v in batch.column("ids")]


def summed(parts: DataFrame) -> list:
    """The element-wise sum of the one array column ``part`` over all rows (empty without rows)."""
    each = parts.select(F.posexplode("part").alias("pos", "value"))
    return [total for _, total in sorted(map(tuple, each.groupBy("pos").agg(F.sum("value")).collect()))]  # one array's length
