"""The pair join with hot keys split over tasks equals the plain join."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from vigilo.operators.hot_keys import hot_pairs, key_load, split_pair_join
from vigilo.operators.pairing import pair_join
from vigilo.session import stage
from vigilo.sources.telemetry import load_metrics
from conftest import SF_SMALL


def _feed(spark, n, hot, value):
    """n rows over 50 keys, every hot-th of them on one key; values repeat."""
    ts = F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") % hot == 0, 0).otherwise(F.col("id") % 50))
    return spark.range(n).select(
        ts.alias("ts"), F.when(F.col("id") % hot == 0, "srv-hot").otherwise("srv-1").alias("server_id"), (F.col("id") % 7).cast("float").alias(value))


def _same(x, y):
    assert x.columns == y.columns
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


@pytest.mark.parametrize("rows_a, rows_b", [(900, 900), (900, 30), (9, 1200)])
@pytest.mark.parametrize("block", [1, 16, 1024])
def test_equals_the_plain_join(spark, rows_a, rows_b, block):
    a, b = _feed(spark, rows_a, 3, "cpu_pct"), _feed(spark, rows_b, 3, "mem_pct")
    _same(split_pair_join(a, b, block), pair_join(a, b))


def test_whole_feeds(spark):
    m = load_metrics(spark, SF_SMALL)
    a, b = m["cpu"], m["mem"]
    assert key_load(a, b, 2).where("a_parts * b_parts > 1").count() > 0
    _same(split_pair_join(a, b, 2), pair_join(a, b))


def test_null_keys_and_empty_sides(spark):
    a = spark.createDataFrame([(None, "s", 1.0), (None, None, 2.0)] * 30, "ts timestamp, server_id string, cpu_pct double")
    a = a.unionByName(_feed(spark, 90, 3, "cpu_pct"))
    b = _feed(spark, 90, 3, "mem_pct").withColumn("ts", F.when(F.col("mem_pct") > 0, F.col("ts")))
    _same(split_pair_join(a, b, 2), pair_join(a, b))
    assert split_pair_join(a, b.limit(0), 2).count() == 0
    assert split_pair_join(a.limit(0), b, 2).count() == 0
    with pytest.raises(ValueError):
        split_pair_join(a.withColumn("_a", F.lit(1)), b)
    with pytest.raises(ValueError):
        key_load(a, b, 0)


def test_a_third_of_both_sides_on_one_key_is_spread(spark):
    a, b = _feed(spark, 3000, 3, "cpu_pct"), _feed(spark, 3000, 3, "mem_pct")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = stage(key_load(a, b, 64).where("server_id = 'srv-hot'"), "hot")
        row = hot.first()
        assert (row.a_n, row.b_n, row.pairs, row.a_parts, row.b_parts) == (1000, 1000, 1e6, 16, 16)
        tasks = [r["count"] for r in hot_pairs(a, b, hot).groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert sum(tasks) == 1_000_000
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(tasks) <= 2 * median(tasks)
