"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import zlib

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(name: str, sf: str = SF) -> list[dict]:
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def docs_frame(spark, texts, extra: bool = False, first: int = 0, partitions: int = 3):
    """A documents table of the given texts; ``extra`` adds columns named like the operators' own."""
    rows = [(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).repartition(partitions)
    if extra:
        for c in ("words", "block", "chunk", "score", "hash", "copy", "label", "tie", "n_words", "start", "kept"):
            df = df.selectExpr("*", f"'x' AS {c}")
    return df


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def got(df, key: str = "doc_id") -> list[dict]:
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: str(r[key]).zfill(20))


AWKWARD = [None, "", " \n\t ", "one", "One two THREE", "a  b\n\n c d\x1ce 　x", "x" * 70_000,
           "word " * 30_000, "é ß 漢字 \U0001F600 <|endoftext|>", "One two THREE", "it's  we'll\r\n\r\nok ", " lead", "trail ", "a. b, c! \u00b2. x\u0301. 5. d.. \u4e2d\uff0c e\u2019. .", "A.\nB,\nC"]
