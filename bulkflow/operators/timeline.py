"""Timelines from flow events (flow, item, event_type, ts, and a column that breaks ties)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.functions.times import seconds_between
from bulkflow.operators.ordered import segmented, with_previous, with_running_sum


def segments(events: DataFrame, tie: str) -> DataFrame:
    """START/END pairs per (flow, item).

    An END closes the latest open START; a START followed by another START, or by nothing,
    is dropped, and so is an END without an open START.
    """
    marks = events.filter(F.col("event_type").isin("START", "END")).select("flow", "item", "event_type", "ts", tie)
    seg = segmented(marks, ["flow", "item"], ["ts", tie])
    paired = with_previous(seg, ["flow", "item"], ["ts", tie], {"event_type": "_type", "ts": "start"})
    return paired.filter((F.col("event_type") == "END") & (F.col("_type") == "START")).select(
        "flow", "item", "start", F.col("ts").alias("end")
    )


def expected_points(events: DataFrame) -> DataFrame:
    """EXPECTED events as zero-length segments of the flow '<flow> EXPECTED'."""
    return events.filter(F.col("event_type") == "EXPECTED").select(
        F.concat("flow", F.lit(" EXPECTED")).alias("flow"), "item", F.col("ts").alias("start"), F.col("ts").alias("end")
    )


def timeline(events: DataFrame, tie: str) -> DataFrame:
    return segments(events, tie).unionByName(expected_points(events))


def expected_vs_actual(events: DataFrame, tie: str) -> DataFrame:
    """The n-th EXPECTED of a (flow, item) beside its n-th START, with the delay in seconds."""
    marks = events.filter(F.col("event_type").isin("EXPECTED", "START")).select(
        "flow", "item", "event_type", "ts", tie, F.lit(1).cast("bigint").alias("_one")
    )
    group, order = ["flow", "item", "event_type"], ["ts", tie]
    counted = with_running_sum(segmented(marks, group, order), group, order, "_one", "ordinal")
    at = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    paired = counted.groupBy("flow", "item", "ordinal").agg(
        at("EXPECTED").alias("expected_at"), at("START").alias("started_at")
    )
    return paired.withColumn("delay_seconds", seconds_between(F.col("expected_at"), F.col("started_at")))


def outcomes(events: DataFrame) -> DataFrame:
    """Per flow the last COMMIT and the last ROLLBACK."""
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    return events.groupBy("flow").agg(last("COMMIT").alias("committed_at"), last("ROLLBACK").alias("rolled_back_at"))


def summary(events: DataFrame, start: Column | None = None) -> DataFrame:
    """Per flow: number of events, last event, outcome times, seconds from the start of all flows."""
    begin = start if start is not None else events.agg(F.min("ts")).scalar()
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    per_flow = events.groupBy("flow").agg(
        F.count(F.lit(1)).alias("events"),
        F.max("ts").alias("ended_at"),
        last("COMMIT").alias("committed_at"),
        last("ROLLBACK").alias("rolled_back_at"),
    )
    return per_flow.withColumn("seconds", seconds_between(begin, F.col("ended_at")))


def total_seconds(events: DataFrame, start: Column | None = None) -> DataFrame:
    begin = start if start is not None else F.min("ts")
    return events.agg(seconds_between(begin, F.max("ts")).alias("total_seconds"))
