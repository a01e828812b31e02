"""Tables put side by side by the position of their rows, as model outputs without keys are.

A row's position is its number in the order of files (by name) and of rows in a file, over however many files and in any format.
Files are read in splits, in parallel: each row is numbered within its split, splits are ordered by (file, offset), and
prefix sums of their row counts (one row per split) make these numbers positions. Tables of different length are an error,
as is a column that both have. (The CSV reader skips blank lines, so a lone column needs a mark for null values.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.session import stored


def with_positions(df: DataFrame, name: str = "_pos") -> tuple[DataFrame, int]:
    """(rows of a table read from files with their positions, number of rows)."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    meta = F.col("_metadata")
    rows = stored(df.select(F.struct("*").alias("row"), meta.file_path.alias("file"), meta.file_block_start.alias("offset"),
                            F.monotonically_increasing_id().alias("at")), "positions")
    splits = rows.groupBy("file", "offset").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "offset").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    splits = stored(splits.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))), "splits")
    total = splits.agg(F.sum("n")).first()[0] or 0
    placed = rows.join(splits, ["file", "offset"])
    return placed.select("row.*", (F.col("skip") + F.col("at") - F.col("first")).alias(name)), total


def attach_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of both tables, row by row."""
    twice = set(left.columns) & set(right.columns)
    if twice:
        raise ValueError(f"columns in both tables: {sorted(twice)}")
    (a, n), (b, m) = with_positions(left), with_positions(right)
    if n != m:
        raise ValueError(f"{n} rows against {m}")
    return a.join(b, "_pos").drop("_pos")
