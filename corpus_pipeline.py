"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Long texts pass every stage whole; further columns of any name are kept as they are up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import decontaminate, mixing, neardup, quality, tokens
from smogline.llm.common import table, written

StageFn = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows packed apart from their id, so that columns of any name clash with nothing. Every row without an id
    is a document of its own: it gets a number after all ids."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    largest, without = rows.agg(F.max("id"), F.count_if(F.col("id").isNull())).first()
    if without:  # numbered where they lie and written, so that the numbers hold
        after = F.lit(-1 if largest is None else largest).cast("long") + 1 + F.monotonically_increasing_id()
        numbered, _ = written(rows.filter("id IS NULL").withColumn("id", after), "without-id")
        rows = rows.filter("id IS NOT NULL").unionByName(numbered)
    return rows


def _ids(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("id")).distinct()


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Rows that share an id are one
    document. Every row without an id is a document of its own that comes after all ids: it goes if its group has an
    id, and of a group without any id one row (any) stays. Rows without text are no copies of each other and stay."""
    rows = _keyed(docs)
    found = neardup.near_duplicates(rows.select(F.col("id").alias("doc_id"), "text"))
    return rows.join(_ids(found.filter("kept")), "id", "left_semi").select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark. Rows that share an id are one document and go together; every row
    without an id is one of its own."""
    rows = _keyed(docs)
    found = decontaminate.find_contamination(rows.select(F.col("id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(_ids(found.filter(F.size("hit_words") > 0)), "id", "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: the written files hold it from first to last."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the documents lie in the files of the stage before (rows without files, as
    in tests: by id), and the digest of every document read back from them."""
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        order = ["doc_id"]
    return tokens.token_digest(tokens.read_tokens(spark, tokens.write_tokens(docs, order_by=order)))


STAGES: list[tuple[str, StageFn]] = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The stages train classifiers, hash and run tokenizers: not expressible in SQL (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's rows become a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
