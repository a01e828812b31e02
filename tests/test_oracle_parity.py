"""Every registered query with an oracle agrees with DuckDB on the same Parquet tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import canon, duck, rows_of_spark, rows_of_sql

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    cols, got = rows_of_spark(QUERIES[name](spark, SF_SMALL))
    want = rows_of_sql(con, ORACLE[name], cols)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


def test_every_query_has_a_builder():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_aqi" in df.columns and "pollution_level" in df.columns
