"""One key, group or instant holds a third of all rows or more."""

import pytest
from pyspark.sql import functions as F

from bulkflow.operators import audit, monitor, timeline
from bulkflow.operators.merge import upsert

N = 300_000


@pytest.fixture
def skew_settings(spark):
    """Small thresholds, so that test-sized data counts as skewed, and no broadcast joins."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(i):
    """A key that is 7 for half of all rows."""
    return F.when(i % 2 == 0, F.lit(7).cast("bigint")).otherwise(i)


def test_upsert_splits_a_hot_target_key(spark, skew_settings, tmp_path):
    path = str(tmp_path / "target")
    spark.range(0, N, 1, 8).select(hot(F.col("id")).alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string").cast("binary")).alias("pad")).write.parquet(path)
    source = spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"), (F.col("id") + 10**9).alias("v"))
    got = upsert(spark.read.parquet(path), source, ["k"])
    plan = executed(got)
    assert "skew=true" in plan
    assert got.filter("k = 7").agg(F.count("*"), F.min("v"), F.max("v")).first()[:] == (N // 2 + 1, 10**9 + 7, 10**9 + 7)


def test_foreign_key_splits_a_hot_child_key(spark, skew_settings, tmp_path):
    path = str(tmp_path / "child")
    spark.range(0, N, 1, 8).select(hot(F.col("id")).alias("ref"), F.md5(F.col("id").cast("string").cast("binary")).alias("pad")).write.parquet(path)
    parent = spark.range(8, 2 * N, 1, 4).toDF("pid")
    got = audit.foreign_key_violations(spark.read.parquet(path), "ref", parent, "pid")
    assert "skew=true" in executed(got)
    assert got.count() == N // 2 + 4


def test_one_group_is_spread_over_segments(spark):
    df = spark.range(0, N, 1, 8).select(hot(F.col("id")).alias("g"), (F.col("id") % 1000 / 8).alias("v"), F.col("id"))
    got = {r.g: r.p90 for r in monitor.nearest_rank(df.filter("g < 10"), ["g"], "v").collect()}
    half = sorted((i % 1000) / 8 for i in range(0, N, 2))
    assert got[7] == sorted([*half, 7 / 8])[int((len(half) + 1) * 0.9)]
    assert got[3] == 3 / 8


def test_hot_flow_and_equal_times(spark):
    """All events of one flow at the same instant: only the tie-breaker orders them."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    events = spark.range(0, 50_000, 1, 8).select(
        "id", F.lit("F").alias("flow"), F.lit("T").alias("item"),
        F.when(F.col("id") % 5 < 3, "START").otherwise("END").alias("event_type"), at.alias("ts"),
    )
    # START START START END END repeats: one pair per five events.
    assert timeline.segments(events, "id").count() == 10_000
    intervals = events.withColumn("duration", F.lit(1.0))
    assert monitor.concurrency(intervals).first()[0] == 50_000
