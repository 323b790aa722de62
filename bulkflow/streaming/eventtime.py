"""Streams by event time: rows are held back until no earlier ones are expected, then handled in order.

After each micro-batch everything older than the newest event time less a delay is released, in
whole seconds.  A row that comes after its time has been released goes to a side table, and so does a
row without a time; nothing is dropped.  What is held back is bounded by the delay, whatever the age of
the stream, and the results depend on the rows and the delay only: while no row is late, any order of
arrival and any split into micro-batches gives the same.

State and results of a micro-batch lie in folders named by its number; each batch reads the state of the
one before and replaces its own, so a batch that is tried again gives the same, once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkflow.functions.times import micros
from bulkflow.operators.monitor import fold_ticks, is_error, tick_counts
from bulkflow.operators.ordered import segmented, with_running_sum
from bulkflow.operators.timeline import segments
from bulkflow.session import delete_dir, list_dirs
from bulkflow.streaming.ingest import for_each_available

SECOND = 1_000_000
_CLOCK = "until bigint, newest bigint"


@dataclass
class Turn:
    """One micro-batch: its number, the one before, and the time up to which rows are released, in microseconds."""

    spark: SparkSession
    path: str
    number: int
    before: int | None
    until: int | None

    def state(self, name: str, schema: T.StructType | str) -> DataFrame:
        """A state table as the micro-batch before left it."""
        if self.before is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/state/{name}/batch={self.before}")

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write a state table for the next micro-batch; gives it as it was written."""
        path = f"{self.path}/state/{name}/batch={self.number}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def emit(self, name: str, df: DataFrame) -> None:
        """Write what this micro-batch adds to a result."""
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={self.number}")

    def prune(self) -> None:
        """Delete state older than a repetition of this micro-batch needs."""
        for folder in list_dirs(self.spark, f"{self.path}/state"):
            for batch in list_dirs(self.spark, folder):
                if self.before is not None and int(batch.rsplit("=", 1)[1]) < self.before:
                    delete_dir(self.spark, batch)


Handler = Callable[[DataFrame, Turn], None]


@dataclass
class EventTime:
    """A stream with rows of ``schema`` that are released by column ``ts``; all files lie below ``path``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    ts: str = "ts"
    delay_seconds: float = 10.0

    def run(self, stream: DataFrame, checkpoint: str, handle: Handler) -> None:
        """Everything the stream holds now; goes on where the checkpoint says."""
        for_each_available(stream, checkpoint, lambda batch, number: self._turn(batch, number, handle))

    def close(self, handle: Handler) -> None:
        """Release what is still held back, as if the stream had ended.

        If it goes on after all, its next micro-batch replaces what this wrote.
        """
        done = self._done()
        if done:
            self._turn(self.spark.createDataFrame([], self.schema), done[-1] + 1, handle, last=True)

    def result(self, name: str, schema: T.StructType | str) -> DataFrame:
        found = list_dirs(self.spark, f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def late(self) -> DataFrame:
        """Rows that came after their time had been released, and rows without a time."""
        return self.result("late", self.schema)

    def held_back(self) -> DataFrame:
        done = self._done()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/state/open/batch={done[-1]}") if done else self.spark.createDataFrame([], self.schema)

    def _done(self) -> list[int]:
        """Numbers of the micro-batches that were finished; the clock is written last."""
        return sorted(int(p.rsplit("=", 1)[1]) for p in list_dirs(self.spark, f"{self.path}/state/clock"))

    def _turn(self, batch: DataFrame, number: int, handle: Handler, last: bool = False) -> None:
        before = max((n for n in self._done() if n < number), default=None)
        turn = Turn(self.spark, self.path, number, before, None)
        clock = turn.state("clock", _CLOCK).first()
        released, newest = (clock.until, clock.newest) if clock else (None, None)
        at = micros(F.col(self.ts))
        rows = batch.select(*self.schema.names)
        is_late = F.col(self.ts).isNull() | (at < released if released is not None else F.lit(False))
        # What was held back is older than the clock's newest time, so only new rows can move it.
        found = rows.agg(F.count(F.when(is_late, 1)).alias("late"), F.max(F.when(~is_late, at)).alias("newest")).first()
        turn.emit("late", rows.filter(is_late) if found["late"] else self.spark.createDataFrame([], self.schema))
        waiting = turn.state("open", self.schema).unionByName(rows.filter(~is_late))
        seen = found["newest"]
        newest = max((n for n in (newest, seen) if n is not None), default=None)
        until = released
        if newest is not None:
            limit = (newest - round(self.delay_seconds * SECOND)) // SECOND * SECOND if not last else newest // SECOND * SECOND + SECOND
            until = limit if released is None else max(released, limit)
        turn.until = until
        due = at < until if until is not None else F.lit(False)
        turn.keep("open", waiting.filter(~due))
        handle(waiting.filter(due), turn)
        turn.keep("clock", self.spark.createDataFrame([(until, newest)], _CLOCK))
        turn.prune()


# -- what is done with rows in order -------------------------------------------------------

TICKS = "tick timestamp_ntz, success bigint, errors bigint, changed bigint, p90 double"


def closed_ticks(released: DataFrame, turn: Turn) -> None:
    """Statistics of one-second ticks, each emitted once, when it is closed: ``ticks``."""
    stats = fold_ticks(tick_counts(released), released)
    turn.emit("ticks", stats.select("tick", "success", "errors", "changed", "p90"))


def changes_against_first(keys: list[str], tie: str, value: str = "value") -> Handler:
    """Good samples that differ from their key's first good sample by event time: ``changes``, with ``baseline``.

    The state is one value per key.
    """

    def handle(released: DataFrame, turn: Turn) -> None:
        kind = T.StructType([*(released.schema[k] for k in keys), T.StructField("baseline", released.schema[value].dataType)])
        good = released.filter(~is_error(value=value))
        known = turn.state("baselines", kind)
        first = good.groupBy(*keys).agg(F.min_by(value, F.struct("ts", tie)).alias("baseline"))
        on = [first[k].eqNullSafe(known[k]) for k in keys]
        fresh = first.join(known, _all(on), "left_anti")
        now = turn.keep("baselines", known.unionByName(fresh))
        named = now.select(*(F.col(k).alias(f"_b_{k}") for k in keys), "baseline")
        compared = good.join(named, _all([good[k].eqNullSafe(F.col(f"_b_{k}")) for k in keys])).filter(F.col(value) != F.col("baseline"))
        turn.emit("changes", compared.select(*released.columns, "baseline"))

    return handle


def paired_events(tie: str, timeout_seconds: float | None = None) -> Handler:
    """START/END pairs per (flow, item), as :func:`bulkflow.operators.timeline.segments` has them: ``pairs``.

    The state is the open START of a (flow, item).  One that stays open for longer than the timeout is
    given up, and listed in ``expired``.
    """

    def handle(released: DataFrame, turn: Turn) -> None:
        marks = released.filter(F.col("event_type").isin("START", "END")).select("flow", "item", "event_type", "ts", tie)
        both = turn.state("starts", marks.schema).unionByName(marks)
        turn.emit("pairs", segments(both, tie))
        # The last mark of each (flow, item) stays open if it is a START.
        opened = _last_marks(both, tie).filter("event_type = 'START'")
        old = F.lit(False)
        if timeout_seconds is not None and turn.until is not None:
            old = micros(F.col("ts")) < turn.until - round(timeout_seconds * SECOND)
        turn.emit("expired", opened.filter(old))
        turn.keep("starts", opened.filter(~old))

    return handle


def _last_marks(marks: DataFrame, tie: str) -> DataFrame:
    at = F.struct("ts", tie)
    last = marks.groupBy("flow", "item").agg(F.max_by(F.struct("event_type", "ts", tie), at).alias("last"))
    return last.select("flow", "item", "last.*")


def peaks(group: str, start: str = "ts", seconds: str = "duration") -> Handler:
    """The peak number of overlapping intervals per group, as :func:`bulkflow.operators.monitor.concurrency` has it.

    The state is a group's level and peak so far, and the ends that are still to come; the running peaks
    are the state table ``levels`` of the last micro-batch, see :func:`peaks_so_far`.
    """

    def handle(released: DataFrame, turn: Turn) -> None:
        kind = released.schema[group].dataType.simpleString()
        levels = turn.state("levels", f"name {kind}, level bigint, peak bigint")
        length = F.round(F.col(seconds) * SECOND).cast("bigint")
        begin = micros(F.col(start))
        lasts = F.coalesce(length > 0, F.lit(False))

        def step(at: Column, n: int) -> Column:
            return F.struct(at.cast("bigint").alias("at"), F.lit(n).cast("bigint").alias("step"))

        # An interval without duration adds its group and nothing else.
        both = F.when(lasts, F.array(step(begin, 1), step(begin + length, -1))).otherwise(F.array(step(begin, 0)))
        new = released.select(F.col(group).alias("name"), F.inline(both))
        steps = turn.state("ends", f"name {kind}, at bigint, step bigint").unionByName(new)
        net = steps.groupBy("name", "at").agg(F.sum("step").alias("step"))
        due = F.col("at") < turn.until if turn.until is not None else F.lit(False)
        turn.keep("ends", net.filter(~due))
        running = with_running_sum(segmented(net.filter(due), ["name"], ["at"]), ["name"], ["at"], "step", "level")
        moved = running.groupBy("name").agg(F.max("level").alias("high"), F.sum("step").alias("change"))
        moved = moved.select(F.col("name").alias("moved_name"), "high", "change")
        joined = levels.join(moved, levels["name"].eqNullSafe(moved["moved_name"]), "full")
        known, base = F.col("peak").isNotNull(), F.coalesce("level", F.lit(0))
        turn.keep(
            "levels",
            joined.select(
                F.when(known, F.col("name")).otherwise(F.col("moved_name")).alias("name"),
                (base + F.coalesce("change", F.lit(0))).alias("level"),
                F.greatest(F.coalesce("peak", F.lit(0)), base + F.coalesce("high", F.lit(0))).alias("peak"),
            ),
        )

    return handle


def peaks_so_far(stream: EventTime, group: str) -> DataFrame:
    """(name, level, peak) after the last micro-batch."""
    kind = stream.schema[group].dataType.simpleString()
    done = stream._done()
    schema = f"name {kind}, level bigint, peak bigint"
    if not done:
        return stream.spark.createDataFrame([], schema)
    return stream.spark.read.schema(schema).parquet(f"{stream.path}/state/levels/batch={done[-1]}")


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
