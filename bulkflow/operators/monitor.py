"""Statistics over poll samples: a sample is (ts, worker, value, err, changed, duration, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bulkflow.functions.times import micros, plus_micros, seconds_between
from bulkflow.operators.ordered import SEGMENT, segmented, with_previous, with_running_sum

P90 = 0.90
# A tick of at most so many rows is ordered in one task.
CROWD = 100_000


def nearest_rank_of_histogram(
    histogram: DataFrame, group: list[str], value: str, count: str, q: float, name: str
) -> DataFrame:
    """Per group the value at 0-based rank min(int(n * q), n - 1), from (value, count) rows."""
    seg = segmented(histogram.select(*group, value, count), group, [value])
    running = with_running_sum(seg, group, [value], count, "_upto", total="_n")
    rank = F.least(F.floor(F.col("_n") * F.lit(q)), F.col("_n") - 1)
    hit = running.filter((F.col("_upto") > rank) & (F.col("_upto") - F.col(count) <= rank))
    return hit.select(*group, F.col(value).alias(name))


def nearest_rank(df: DataFrame, group: list[str], value: str, q: float = P90, name: str = "p90") -> DataFrame:
    """Exact nearest-rank percentile per group without gathering a group in one task."""
    histogram = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_count"))
    return nearest_rank_of_histogram(histogram, group, value, "_count", q, name)


def is_error(err: str = "err", value: str = "value") -> Column:
    """A sample failed when it has an error or no value."""
    return F.col(err).isNotNull() | F.col(value).isNull() | (F.col(value) == "")


def in_window(samples: DataFrame, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    return samples.filter(F.col(ts).between(start, end))


def _tick_of(samples: DataFrame) -> list[Column]:
    undated = F.lit(0).cast("timestamp").cast(samples.schema["ts"].dataType)
    window = F.window(F.coalesce("ts", undated), "1 second")
    return [window.alias("window"), F.col("ts").isNull().alias("undated")]


def tick_counts(samples: DataFrame) -> DataFrame:
    """Per one-second tick and duration: successes, errors and changes.  Works on streams too.

    Samples without a time are counted in a tick without a time.
    """
    ok = ~is_error()
    return samples.groupBy(*_tick_of(samples), "duration").agg(
        F.count(F.when(ok, 1)).alias("success"),
        F.count(F.when(~ok, 1)).alias("errors"),
        F.count(F.when(ok & F.col("changed"), 1)).alias("changed"),
        F.count(F.lit(1)).alias("samples"),
    )


def _crowded_ticks(rows: DataFrame) -> DataFrame | None:
    """Ticks with more than :data:`CROWD` rows, of samples or of :func:`tick_counts`; None if there are none."""
    ticks = _tick_of(rows) if "ts" in rows.columns else [F.col("window"), F.col("undated")]
    sizes = rows.groupBy(*ticks).agg(F.count(F.lit(1)).alias("rows"))
    if (sizes.agg(F.max("rows")).first()[0] or 0) <= CROWD:
        return None
    return sizes.filter(F.col("rows") > CROWD).select(_tick().alias("crowded"))


def _tick() -> Column:
    return F.when(~F.col("undated"), F.col("window.start"))


def fold_ticks(counts: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Tick statistics from the rows of :func:`tick_counts`.

    A tick is ordered in one task, unless it has more than :data:`CROWD` rows; those few are spread over
    many tasks.  A tick has no more durations than ``samples``, so its samples may be counted for that
    when they are cheaper to read than ``counts``.
    """
    crowded = _crowded_ticks(counts if samples is None else samples)
    flat = counts.select(_tick().alias("tick"), "duration", "success", "errors", "changed", "samples")
    if crowded is None:
        return _fold_in_tasks(flat)
    large = F.col("tick").eqNullSafe(F.col("crowded"))
    apart = flat.join(F.broadcast(crowded), large, "left_semi")
    return _fold_in_tasks(flat.join(F.broadcast(crowded), large, "left_anti")).unionByName(_fold_spread(apart))


def _fold_in_tasks(flat: DataFrame) -> DataFrame:
    timed = F.when(F.col("duration").isNotNull(), F.col("samples"))
    tick = Window.partitionBy("tick")
    upto = F.sum(timed).over(tick.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0))
    ranked = flat.withColumns({"_upto": upto, "_n": F.sum(timed).over(tick)})
    at_rank = F.col("duration").isNotNull() & (F.col("_upto") > F.least(F.floor(F.col("_n") * F.lit(P90)), F.col("_n") - 1))
    return ranked.groupBy("tick").agg(*_totals(), F.min(F.when(at_rank, F.col("duration"))).alias("p90"))


def _fold_spread(flat: DataFrame) -> DataFrame:
    totals = flat.groupBy("tick").agg(*_totals())
    timed = flat.filter(F.col("duration").isNotNull())
    p90 = nearest_rank_of_histogram(timed, ["tick"], "duration", "samples", P90, "p90")
    at = p90.withColumnRenamed("tick", "p90_tick")
    return totals.join(at, totals["tick"].eqNullSafe(at["p90_tick"]), "left").drop("p90_tick")


def _totals() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("success", "errors", "changed")]


def tumbling_stats(samples: DataFrame) -> DataFrame:
    """Per second: success, errors, changed, p90 of all durations."""
    return fold_ticks(tick_counts(samples), samples)


def baseline(samples: DataFrame, order: list[str]) -> DataFrame:
    """The value of the first good sample, as a table of one row."""
    at = F.when(~is_error(), F.struct(*order))
    return samples.agg(F.min_by(F.col("value"), at).alias("baseline"))


def flag_changes(samples: DataFrame, initial: Column) -> DataFrame:
    """``changed`` per sample against a fixed baseline; false when either side is empty."""
    differs = (F.col("value") != initial) & (F.col("value") != "") & (initial != "")
    return samples.withColumn("changed", F.coalesce(differs, F.lit(False)))


def first_change(samples: DataFrame, initial: Column, order: list[str]) -> DataFrame:
    """Time and value of the first good sample that differs from the baseline.

    An empty baseline is set by the first good sample.
    """
    known = F.coalesce(F.nullif(initial, F.lit("")), baseline(samples, order).scalar())
    hit = ~is_error() & (F.col("value") != known)
    first = F.min_by(F.struct("ts", "value"), F.when(hit, F.struct(*order)))
    return samples.withColumn("_known", known).filter(F.col("_known").isNotNull()).agg(first.alias("f")).select(
        F.col("f.ts").alias("first_change_at"), F.col("f.value").alias("first_change_value")
    )


def every_change(samples: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Good samples whose value differs from the previous good sample of the group."""
    good = samples.filter(~is_error())
    seg = segmented(good, group, order)
    flagged = with_previous(seg, group, order, {"value": "previous_value"})
    return flagged.filter(F.col("previous_value").isNotNull() & (F.col("value") != F.col("previous_value"))).drop(SEGMENT)


def change_lag(samples: DataFrame, initial: Column, trigger: Column, order: list[str]) -> DataFrame:
    """Seconds from the trigger to the first observed change."""
    return first_change(samples, initial, order).withColumn(
        "lag_seconds", seconds_between(trigger, F.col("first_change_at"))
    )


def poll_summary(samples: DataFrame, initial: Column, order: list[str]) -> DataFrame:
    """One row: totals, peak congestion, p90 over all samples, first change."""
    ok = ~is_error()
    totals = samples.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(ok, 1)).alias("success"),
        F.count(F.when(~ok, 1)).alias("errors"),
        F.coalesce(F.max("congestion"), F.lit(0)).cast("bigint").alias("max_congestion"),
    )
    change = first_change(samples, initial, order)
    return totals.withColumns(
        {
            "p90": F.coalesce(nearest_rank(samples, [], "duration").scalar(), F.lit(0.0)),
            "first_change_at": change.select("first_change_at").scalar(),
            "first_change_value": change.select("first_change_value").scalar(),
        }
    )


def concurrency(intervals: DataFrame, start: str = "ts", seconds: str = "duration", group: list[str] | None = None) -> DataFrame:
    """Peak number of intervals [start, start + seconds) that overlap, per group.

    Starts and ends at the same instant are netted before the running sum, so the ordered
    part works on distinct instants only.  Intervals without a start, a length or any duration
    overlap nothing; a group of such intervals only has a peak of 0.
    """
    group = group or []
    length = F.round(F.col(seconds) * 1_000_000).cast("bigint")
    begin = micros(F.col(start))
    lasts = F.col(start).isNotNull() & (length > 0)

    def step(at: Column, n: int) -> Column:
        return F.struct(at.cast("bigint").alias("at"), F.lit(n).cast("bigint").alias("step"))

    steps = intervals.select(
        *group, F.inline(F.when(lasts, F.array(step(begin, 1), step(begin + length, -1))).otherwise(F.array(step(F.lit(None), 0))))
    )
    net = steps.groupBy(*group, "at").agg(F.sum("step").alias("step")).filter((F.col("step") != 0) | F.col("at").isNull())
    running = with_running_sum(segmented(net, group, ["at"]), group, ["at"], "step", "in_flight")
    return running.groupBy(*group).agg(F.coalesce(F.max("in_flight"), F.lit(0)).cast("bigint").alias("max_in_flight"))


def interval_end(start: Column, seconds: Column) -> Column:
    return plus_micros(start, F.round(seconds * 1_000_000).cast("bigint"))
