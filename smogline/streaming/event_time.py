"""Deduplication in event time: a watermark bounds the state, and what comes too late goes to a table of its own.

A run has three steps, each continuing where its own checkpoint stands:

1. documents become rows; complete ones are stored in ``arrived``, the others in ``rejected`` (a folder per batch, which a
   retried batch replaces);
2. ``arrived`` is read as a stream: ``withWatermark`` and ``dropDuplicatesWithinWatermark`` on (station, time), appended to
   ``main`` by the exactly-once file sink. A reading older than the watermark is dropped by the engine here, and a
   key's state goes once the watermark has passed it: since time is a part of the key, no copy can come in after that;
3. arrived rows whose key is neither in ``main`` nor in ``late`` are those dropped: they are appended to ``late``. Only
   batches not looked at before, and only the months they touch, are compared.

Step 2 only ever sees what step 1 finished, so step 3 misses nothing that arrives meanwhile. ``main`` and ``late`` together hold
every complete reading once, however a backlog is cut into batches; which of the two holds it depends on the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline import schemas
from smogline.operators.clean import REQUIRED, flatten_reading
from smogline.operators.dedup import latest_per_key, new_keys
from smogline.sources.files import existing_paths
from smogline.streaming.ingest import KEYS, document_stream, run_available

DELAY = "48 hours"
ROWS = [f for f in schemas.FACT_AQI.fields if f.name not in ("year", "month")]
ARRIVED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROWS) + ", year string, month string"


def _arrive(spark: SparkSession, source: str, root: str, ingested_at: str, multi_line: bool, max_files: int | None) -> None:
    complete = F.lit(True)
    for c in REQUIRED:
        complete = complete & F.col(c).isNotNull()

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = flatten_reading(batch, ingested_at=ingested_at).select(*[f.name for f in schemas.FACT_AQI.fields]).persist()
        try:
            rows.filter(complete).write.mode("overwrite").parquet(f"{root}/arrived/batch={batch_id}")
            rows.filter(~complete).write.mode("overwrite").parquet(f"{root}/rejected/batch={batch_id}")
        finally:
            rows.unpersist()

    run_available(document_stream(spark, source, multi_line, max_files), f"{root}/_arrive", store)


def _deduplicate(spark: SparkSession, root: str, delay: str, max_files: int | None) -> None:
    reader = spark.readStream.schema(ARRIVED + ", batch long")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(f"{root}/arrived").drop("batch")
    fresh = rows.withWatermark("measured_at", delay).dropDuplicatesWithinWatermark(KEYS)
    (fresh.writeStream.format("parquet").outputMode("append").partitionBy("queried_city", "year", "month")
     .option("path", f"{root}/main").option("checkpointLocation", f"{root}/_main").trigger(availableNow=True)
     .start().awaitTermination())


def _keep_late(spark: SparkSession, root: str) -> None:
    arrived = spark.read.schema(ARRIVED + ", batch long").parquet(f"{root}/arrived")
    seen = [int(p.rsplit("=", 1)[1]) for p in existing_paths(spark, [f"{root}/late/batch=*"])]
    rows = arrived.filter(F.col("batch") > max(seen, default=-1))
    found = rows.agg(F.max("batch").alias("last"), F.collect_set(F.struct("year", "month")).alias("months")).first()
    if found["last"] is None:
        return
    touched = F.struct("year", "month").isin([F.struct(F.lit(m["year"]), F.lit(m["month"])) for m in found["months"]])
    main = spark.read.schema(ARRIVED).parquet(f"{root}/main").filter(touched)
    late = new_keys(latest_per_key(rows.drop("batch"), KEYS, ["ingested_at"]), main, KEYS)
    if seen:
        late = new_keys(late, spark.read.schema(ARRIVED + ", batch long").parquet(f"{root}/late").filter(touched), KEYS)
    late.write.mode("overwrite").parquet(f"{root}/late/batch={found['last']}")


def event_time_stream(spark: SparkSession, source: str, root: str, ingested_at: str, delay: str = DELAY,
                      multi_line: bool = False, max_files: int | None = None) -> None:
    """Process the documents that arrived since the last run; blocks until done. ``root`` holds tables and checkpoints."""
    _arrive(spark, source, root, ingested_at, multi_line, max_files)
    if existing_paths(spark, [f"{root}/arrived"]):
        _deduplicate(spark, root, delay, max_files)
        _keep_late(spark, root)


def read_event_time(spark: SparkSession, root: str) -> DataFrame:
    """Every complete reading once, and whether it came too late."""
    names = [f.name for f in schemas.FACT_AQI.fields]
    main = spark.read.schema(ARRIVED).parquet(f"{root}/main")
    late = spark.read.schema(ARRIVED + ", batch long").parquet(f"{root}/late")
    return (main.select(*names, F.lit(False).alias("late"))
            .unionByName(late.select(*names, F.lit(True).alias("late"))))
