"""A digest index keeps its number of buckets, whatever the session that opens it again."""

import pytest

from wearspan.llm import exact


def test_reopened_with_other_partitions(spark, make):
    rows = [(i, f"text number {i}") for i in range(200)]
    index = exact.DigestIndex(spark, buckets=8)
    assert exact.dedup(make(rows), index).where("kept").count() == 200
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = exact.DigestIndex(spark, index.path)
        assert again.buckets == 8
        assert exact.dedup(make(rows), again).where("kept").count() == 0
        assert exact.keep_first(make([*rows, (999, "new")]), again).count() == 1
        assert again.rows().count() == 201
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError, match="8 buckets"):
        exact.DigestIndex(spark, index.path, buckets=3)
