"""Streaming forms of the monitor statistics, by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.operators.monitor import baseline, flag_changes, fold_ticks, is_error, tick_counts
from bulkflow.session import list_dirs
from bulkflow.streaming.ingest import for_each_available


def write_tick_counts(samples: DataFrame, checkpoint: str, path: str) -> None:
    """Counts per one-second tick and duration of every micro-batch, in a folder of its own.

    A batch that is tried again replaces its folder, so a restart neither loses nor doubles
    samples.  Nothing is kept in memory between batches, and a late sample is counted in its
    tick whenever it comes: no sample is ever dropped.
    """

    def write(batch: DataFrame, number: int) -> None:
        tick_counts(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    for_each_available(samples, checkpoint, write)


def tick_stats(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of all ticks seen so far, the open last one included."""
    counts = spark.read.parquet(path)
    sums = [F.sum(c).alias(c) for c in ("success", "errors", "changed", "samples")]
    return fold_ticks(counts.groupBy("window", "undated", "duration").agg(*sums), counts)


def write_changes(samples: DataFrame, checkpoint: str, path: str, initial: str = "") -> None:
    """Good samples that differ from the baseline, written as they arrive.

    An empty baseline is set by the first good sample of the first micro-batch that has one;
    that single value is stored beside the changes, so a restart goes on with it.
    """
    spark = samples.sparkSession
    order = ["ts", "sample_id"]
    stored = StoredBaseline(spark, f"{path}/baseline")

    def write(batch: DataFrame, number: int) -> None:
        known = initial or stored.read()
        if not known:
            known = baseline(batch, order).first()["baseline"]
            if known:
                stored.write(known, number)
        # A batch before the first good sample writes an empty folder, so there is always one to read.
        changed = flag_changes(batch.filter(~is_error()), F.lit(known or "")).filter(F.col("changed") & F.lit(bool(known)))
        changed.withColumn("baseline", F.lit(known).cast("string")).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    for_each_available(samples, checkpoint, write)


class StoredBaseline:
    """One value kept in a folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> str | None:
        if not list_dirs(self.spark, self.path):
            return None
        rows = self.spark.read.schema("baseline string, batch bigint").parquet(self.path)
        return rows.agg(F.min_by("baseline", "batch")).first()[0]

    def write(self, value: str, number: int) -> None:
        one = self.spark.createDataFrame([(value,)], "baseline string")
        one.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
