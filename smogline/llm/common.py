"""Shared helpers of the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import scratch_path, ship_package

#: Rows of one Arrow batch handed to Python; texts may be long, so batches stay short.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session options the Python stages rely on: short Arrow batches, the package on the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, fmt: str = "parquet", **options: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder (a lineage cut that survives lost executors), and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.format(fmt).options(**options).save(path)
    return spark.read.format(fmt).schema(schema).load(path), path


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text (the fold assignment of the classifiers); -1 for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(-1))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(spark: SparkSession, amount: int, per_group: int) -> int:
    """How many groups keep each near ``per_group``; never fewer than the shuffle partitions."""
    return max(shuffle_partitions(spark), math.ceil(amount / per_group))


def text_bytes(docs: DataFrame, col: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of ``col``) in one aggregate."""
    row = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(col))).first()
    return int(row[0]), int(row[1] or 0)


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """The least row of each key: copies of a key that holds many rows collapse inside the map tasks."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("least")).select(
        *[F.col(key) if c == key else F.col(f"least.{c}").alias(c) for c in df.columns])


def hash_sample(df: DataFrame, key: str, rows: int, total: int, salt: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of ``key`` (all of them when fewer), and one row per key: the
    bounded, repeatable training sample of the classifiers."""
    if total > rows:
        h = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30))
        df = df.filter(h < int(rows / total * (1 << 30)))
    return one_row_per(df, key)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` of a function on single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text (null: empty)."""
    return [b"" if v is None else v for v in batch.column(col).cast(pa.binary()).to_pylist()]
