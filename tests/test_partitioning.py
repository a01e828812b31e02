"""Results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_MID
from tests.oracle import canon, rows_of_spark

NAMES = ["daily_summary", "latest_per_key", "feature_table", "box_stats", "spearman"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_independence(spark, name):
    q = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = canon(rows_of_spark(q(spark, SF_MID))[1])
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = canon(rows_of_spark(q(spark, SF_MID))[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
