"""File sources and sinks: station CSV, API JSON, scored parts, partitioned tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smogline import schemas
from smogline.functions.columns import null_if_tokens


def read_station_csv(spark: SparkSession, path: str, header_schema=schemas.STATION_CSV) -> DataFrame:
    """Raw station CSV: every column as text (cleaned later; no inference pass)."""
    return (spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", False)
            .schema(header_schema).csv(path))


def read_api_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested API documents with the Hive path columns (queried_city/year/month/day)."""
    return (spark.read.schema(schemas.API_DOCUMENT_WITH_PATH).option("multiLine", multi_line)
            .option("basePath", path).json(path))


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under a folder, at any depth."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def read_scored(spark: SparkSession, path: str, columns: Sequence[str], value: str) -> DataFrame:
    """Scored CSV parts (``*.csv`` and ``*.out`` only); rows whose ``value`` is not a number are dropped."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.option("header", False).option("pathGlobFilter", "*.{csv,out}").schema(schema).csv(path)
    return raw.withColumn(value, null_if_tokens(value).try_cast("double")).filter(F.col(value).isNotNull())


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append",
                dynamic: bool = False, fmt: str = "parquet") -> None:
    """Partitioned write; ``dynamic`` overwrite replaces only the partitions present in ``df``
    (idempotent reruns of a gold build)."""
    w = df.write.mode(mode).option("compression", "snappy" if fmt == "parquet" else "none")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def write_gold_records(df: DataFrame, path: str, run_id: str, dt: str, fmt: str = "json") -> None:
    """Gold output rows under ``dt=YYYYMMDD`` with the run id attached."""
    out = df.withColumn("run_id", F.lit(run_id)).withColumn("dt", F.lit(dt))
    write_table(out, path, ["dt"], mode="append", fmt=fmt)


def existing_paths(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """The folders and files that match the glob patterns (one listing per pattern, nothing below them)."""
    sc = spark.sparkContext
    found = []
    for pattern in patterns:
        path = sc._jvm.org.apache.hadoop.fs.Path(pattern)
        status = path.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(path)
        found += [s.getPath().toString() for s in status or ()]
    return found


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(existing_paths(spark, [path]))


def run_once(spark: SparkSession, flag_path: str, job: Callable[[], None]) -> bool:
    """Run ``job`` unless the flag exists; write the flag only after success. Returns True if run."""
    if path_exists(spark, flag_path):
        return False
    job()
    spark.createDataFrame([(flag_path,)], "flag string").coalesce(1).write.mode("overwrite").json(flag_path)
    return True


def observed_counts(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Attach row counters (total plus named conditions) computed during the next action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *metrics), obs
