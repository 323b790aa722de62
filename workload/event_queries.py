"""Monitor statistics, timelines and streams.

The events stand in for poll samples: ``user_id`` is the worker, ``event_type`` the value read,
``value`` the duration in seconds, and an event of type error a failed poll.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions import parse, times
from bulkflow.operators import monitor, timeline
from bulkflow.plans import tables
from bulkflow.plans.publish import Snapshot
from bulkflow.session import fresh_dir, fresh_name, list_dirs, make_dir, rename
from bulkflow.streaming import ingest
from bulkflow.streaming import monitor as stream_monitor
from bulkflow.streaming.eventtime import TICKS, EventTime, changes_against_first, closed_ticks, paired_events, peaks, peaks_so_far
from workload.common import Registry, table, text_columns

registry = Registry()
query = registry.query

_ORDER = ["ts", "sample_id"]
_SAMPLE_SCHEMA = (
    "sample_id bigint, ts timestamp_ntz, worker bigint, value string, err string, duration double, congestion int, changed boolean"
)


def _samples(spark: SparkSession, sf_dir: str, initial: str = "view") -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sample_id"),
        "ts",
        F.col("user_id").alias("worker"),
        F.col("event_type").alias("value"),
        F.when(F.col("event_type") == "error", "timeout").alias("err"),
        F.col("value").alias("duration"),
        F.get_json_object("props", "$.k").cast("int").alias("congestion"),
    )
    return monitor.flag_changes(events, F.lit(initial))


_GOOD = "event_type <> 'error'"
_RANK = "least(CAST(floor(n * 0.90) AS BIGINT), n - 1) + 1"


def _p90_sql(source: str, keys: str, value: str) -> str:
    by = f"PARTITION BY {keys} " if keys else ""
    columns = f"{keys}, " if keys else ""
    return f"""(SELECT {columns}{value} AS p90 FROM (SELECT *, row_number() OVER ({by}ORDER BY {value}) AS rn,
      count(*) OVER ({by}) AS n FROM {source}) WHERE rn = {_RANK})"""


_TICKS = """(SELECT *, date_trunc('second', ts) AS tick FROM events)"""
_SOME_UNDATED = """(SELECT *, CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS tick FROM events)"""


def _tick_stats(ticks: str) -> str:
    return f"""SELECT t.tick, CAST(count(*) FILTER ({_GOOD}) AS BIGINT) AS success,
    CAST(count(*) FILTER (NOT ({_GOOD})) AS BIGINT) AS errors,
    CAST(count(*) FILTER ({_GOOD} AND event_type <> 'view') AS BIGINT) AS changed, any_value(p90) AS p90
    FROM {ticks} t JOIN {_p90_sql(ticks, 'tick', 'value')} p ON t.tick IS NOT DISTINCT FROM p.tick GROUP BY t.tick"""


_TICK_STATS = _tick_stats(_TICKS)


@query(_tick_stats(_SOME_UNDATED))
def tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of all samples; clicks have no time and are a tick of their own."""
    samples = _samples(spark, sf_dir)
    return monitor.tumbling_stats(samples.withColumn("ts", F.when(F.col("value") != "click", F.col("ts"))))


@query(f"SELECT l_returnflag, l_linestatus, p90 FROM {_p90_sql('lineitem', 'l_returnflag, l_linestatus', 'l_extendedprice')}")
def p90_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.nearest_rank(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


_FIRST_CHANGE = """(SELECT ts, event_type FROM events WHERE event_type NOT IN ('error', 'signup') ORDER BY ts, event_id LIMIT 1)"""


@query(
    f"""SELECT count(*) AS total, count(*) FILTER ({_GOOD}) AS success, count(*) FILTER (NOT ({_GOOD})) AS errors,
    CAST(max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS max_congestion,
    (SELECT p90 FROM {_p90_sql('events', '', 'value')}) AS p90,
    (SELECT ts FROM {_FIRST_CHANGE}) AS first_change_at, (SELECT event_type FROM {_FIRST_CHANGE}) AS first_change_value
    FROM events"""
)
def poll_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.poll_summary(_samples(spark, sf_dir), F.lit("signup"), _ORDER)


@query(
    """SELECT count(*) AS samples, count(*) FILTER (event_type = 'error') AS errors FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"""
)
def observation_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda day: F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz")
    seen = monitor.in_window(_samples(spark, sf_dir), at(10), at(20))
    return seen.agg(F.count(F.lit(1)).alias("samples"), F.count(F.when(monitor.is_error(), 1)).alias("errors"))


@query(
    """SELECT event_id AS sample_id, event_type <> base AS changed FROM events,
    (SELECT event_type AS base FROM events WHERE event_type <> 'error' ORDER BY ts, event_id LIMIT 1)"""
)
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir)
    first = monitor.baseline(samples, _ORDER).scalar()
    return monitor.flag_changes(samples, first).select("sample_id", "changed")


@query(
    f"""SELECT worker, sample_id, value, previous_value FROM (SELECT user_id AS worker, event_id AS sample_id, event_type AS value,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_value FROM events WHERE {_GOOD})
    WHERE previous_value IS NOT NULL AND value <> previous_value"""
)
def every_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = monitor.every_change(_samples(spark, sf_dir), ["worker"], _ORDER)
    return changes.select("worker", "sample_id", "value", "previous_value")


@query(
    f"""SELECT ts AS first_change_at, event_type AS first_change_value,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS lag_seconds FROM {_FIRST_CHANGE}"""
)
def change_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    trigger = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return monitor.change_lag(_samples(spark, sf_dir), F.lit("signup"), trigger, _ORDER)


@query(
    """WITH kept AS (SELECT event_type, CASE WHEN event_type <> 'signup' THEN ts END AS ts, CASE WHEN event_type <> 'click' THEN value ELSE 0 END AS value FROM events),
    step AS (SELECT event_type, epoch_us(ts) AS instant, 1 AS s FROM kept WHERE value > 0 UNION ALL
      SELECT event_type, epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT), -1 FROM kept WHERE value > 0),
    net AS (SELECT event_type, instant, sum(s) AS s FROM step WHERE instant IS NOT NULL GROUP BY 1, 2),
    run AS (SELECT event_type, sum(s) OVER (PARTITION BY event_type ORDER BY instant) AS n FROM net UNION ALL SELECT event_type, 0 FROM kept)
    SELECT event_type AS value, CAST(max(n) AS BIGINT) AS max_in_flight FROM run GROUP BY 1"""
)
def max_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks by kind of event; clicks take no time and signups have none, so both peak at 0."""
    samples = _samples(spark, sf_dir)
    ts = F.when(F.col("value") != "signup", F.col("ts"))
    return monitor.concurrency(samples.withColumns({"ts": ts, "duration": F.when(F.col("value") != "click", F.col("duration")).otherwise(0.0)}), group=["value"])


# -- timelines ---------------------------------------------------------------------------

_KIND = """CASE event_type WHEN 'view' THEN 'START' WHEN 'purchase' THEN 'END' WHEN 'click' THEN 'EXPECTED'
    WHEN 'error' THEN 'ROLLBACK' ELSE 'COMMIT' END"""
_FLOWS = f"(SELECT event_id, 'U' || user_id AS flow, 'T' AS item, {_KIND} AS event_type, ts FROM events)"


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"view": "START", "purchase": "END", "click": "EXPECTED", "error": "ROLLBACK", "signup": "COMMIT"}
    kind = F.lit(None).cast("string")
    for k, v in kinds.items():
        kind = F.when(F.col("event_type") == k, v).otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("U"), "user_id").alias("flow"), F.lit("T").alias("item"), kind.alias("event_type"), "ts"
    )


@query(
    """SELECT ts, 'U' || user_id AS who, event_type || ' ' || props AS msg, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS shown
    FROM events ORDER BY ts"""
)
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "ts", F.concat(F.lit("U"), "user_id").alias("who"), F.concat_ws(" ", "event_type", "props").alias("msg")
    )
    name = fresh_name("event_log")[:28]
    tables.create_or_replace(spark, name, events.schema)
    tables.append(events, name)
    return spark.table(name).withColumn("shown", times.format_millis(F.col("ts"))).orderBy("ts")


@query(
    f"""SELECT flow, item, start, "end" FROM (SELECT flow, item, event_type, ts AS "end",
    lag(event_type) OVER w AS prev, lag(ts) OVER w AS start FROM {_FLOWS} WHERE event_type IN ('START', 'END')
    WINDOW w AS (PARTITION BY flow, item ORDER BY ts, event_id)) WHERE event_type = 'END' AND prev = 'START'
    UNION ALL SELECT flow || ' EXPECTED', item, ts, ts FROM {_FLOWS} WHERE event_type = 'EXPECTED'"""
)
def event_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.timeline(_flows(spark, sf_dir), "event_id")


@query(
    f"""SELECT flow, item, ordinal, expected_at, started_at, (epoch_us(started_at) - epoch_us(expected_at)) / 1e6 AS delay_seconds
    FROM (SELECT flow, item, ordinal, min(ts) FILTER (event_type = 'EXPECTED') AS expected_at,
      min(ts) FILTER (event_type = 'START') AS started_at
      FROM (SELECT *, row_number() OVER (PARTITION BY flow, item, event_type ORDER BY ts, event_id) AS ordinal
        FROM {_FLOWS} WHERE event_type IN ('EXPECTED', 'START')) GROUP BY 1, 2, 3)"""
)
def expected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.expected_vs_actual(_flows(spark, sf_dir), "event_id")


@query(
    f"""SELECT flow, count(*) AS events, max(ts) AS ended_at, max(ts) FILTER (event_type = 'COMMIT') AS committed_at,
    max(ts) FILTER (event_type = 'ROLLBACK') AS rolled_back_at,
    (epoch_us(max(ts)) - (SELECT epoch_us(min(ts)) FROM events)) / 1e6 AS seconds FROM {_FLOWS} GROUP BY 1"""
)
def timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.summary(_flows(spark, sf_dir))


# -- streams -----------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, value FROM events")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder, converted and appended as a stream, then published once."""
    folder = fresh_dir(spark, "arrivals")
    columns = ["event_id", "user_id", "event_type", "value"]
    tables.write_csv(text_columns(table(spark, sf_dir, "events").select(*columns)), folder)
    parsers = dict(zip(columns, [parse.parse_int, parse.parse_int, parse.parse_string, parse.parse_float]))
    snapshot = Snapshot(spark, fresh_name("ingest"))
    stream = ingest.read_csv_stream(spark, folder, columns)
    ingest.ingest(stream, parsers, fresh_dir(spark, "ingest"), fresh_dir(spark, "progress"), snapshot)
    return snapshot.read().select(*columns)


def _sample_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "samples")
    _samples(spark, sf_dir).write.parquet(folder)
    return spark.readStream.schema(_SAMPLE_SCHEMA).parquet(folder)


@query(_TICK_STATS)
def stream_tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks of a stream that has read everything, the last one included."""
    out = fresh_dir(spark, "ticks")
    stream_monitor.write_tick_counts(_sample_stream(spark, sf_dir), fresh_dir(spark, "progress"), out)
    return stream_monitor.tick_stats(spark, out).select("tick", "success", "errors", "changed", "p90")


@query(
    """SELECT event_id AS sample_id, event_type AS value, base AS baseline FROM events,
    (SELECT event_type AS base FROM events WHERE event_type <> 'error' ORDER BY ts, event_id LIMIT 1)
    WHERE event_type <> 'error' AND event_type <> base"""
)
def stream_change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "changes")
    stream_monitor.write_changes(_sample_stream(spark, sf_dir), fresh_dir(spark, "progress"), out)
    return spark.read.parquet(f"{out}/changes").select("sample_id", "value", "baseline")


# -- streams by event time ---------------------------------------------------------------


def _in_four_parts(spark: SparkSession, rows: DataFrame, handle, delay_seconds: float = 3600.0) -> EventTime:
    """Rows arrive in four parts by time, half of them up to half an hour late; then the stream ends."""
    folder, progress = fresh_dir(spark, "arrivals"), fresh_dir(spark, "progress")
    events = EventTime(spark, fresh_dir(spark, "eventtime"), rows.schema, delay_seconds=delay_seconds)
    late = F.when(F.pmod(F.xxhash64("ts"), F.lit(2)) == 0, 1800).otherwise(0)
    arrival = times.micros(F.col("ts")) + late * 1_000_000
    bounds = rows.agg(F.min(arrival).alias("low"), F.max(arrival).alias("high"))
    quarter = F.floor((arrival - bounds.select("low").scalar()) * 4 / (bounds.select(F.col("high") - F.col("low")).scalar() + 1))
    rows.withColumn("part", quarter).write.partitionBy("part").parquet(folder)
    inbox = make_dir(spark, fresh_dir(spark, "inbox"))
    for n, part in enumerate(list_dirs(spark, folder)):
        rename(spark, part, f"{inbox}/{n}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(inbox)
        events.run(stream, progress, handle)
    events.close(handle)
    return events


@query(_TICK_STATS)
def stream_closed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick once, when no earlier sample is expected any more."""
    return _in_four_parts(spark, _samples(spark, sf_dir), closed_ticks).result("ticks", TICKS)


@query(
    """WITH good AS (SELECT * FROM events WHERE event_type <> 'error'), first AS (SELECT user_id % 50 AS k, arg_min(event_type, (ts, event_id)) AS base
    FROM good GROUP BY 1) SELECT event_id AS sample_id, k AS source, event_type AS value, base AS baseline
    FROM good JOIN first ON k = user_id % 50 WHERE event_type <> base"""
)
def stream_changes_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of fifty sources that differ from their source's first good sample by event time."""
    samples = _samples(spark, sf_dir).withColumn("source", F.pmod("worker", F.lit(50)).cast("bigint"))
    found = _in_four_parts(spark, samples, changes_against_first(["source"], "sample_id"))
    schema = samples.schema.add("baseline", "string")
    return found.result("changes", schema).select("sample_id", "source", "value", "baseline")


@query(
    f"""SELECT flow, item, start, "end" FROM (SELECT flow, item, event_type, ts AS "end",
    lag(event_type) OVER w AS prev, lag(ts) OVER w AS start FROM {_FLOWS} WHERE event_type IN ('START', 'END')
    WINDOW w AS (PARTITION BY flow, item ORDER BY ts, event_id)) WHERE event_type = 'END' AND prev = 'START'"""
)
def stream_event_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """START/END pairs as they are closed; the state is one open START per flow and item."""
    found = _in_four_parts(spark, _flows(spark, sf_dir), paired_events("event_id"))
    return found.result("pairs", "flow string, item string, start timestamp_ntz, end timestamp_ntz")


@query(
    """WITH step AS (SELECT event_type, epoch_us(ts) AS instant, 1 AS s FROM events WHERE CAST(round(value * 1000000) AS BIGINT) > 0 UNION ALL
      SELECT event_type, epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT), -1 FROM events WHERE CAST(round(value * 1000000) AS BIGINT) > 0
      UNION ALL SELECT event_type, epoch_us(ts), 0 FROM events),
    net AS (SELECT event_type, instant, sum(s) AS s FROM step GROUP BY 1, 2),
    run AS (SELECT event_type, sum(s) OVER (PARTITION BY event_type ORDER BY instant) AS n FROM net)
    SELECT event_type AS value, CAST(max(n) AS BIGINT) AS max_in_flight FROM run GROUP BY 1"""
)
def stream_max_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The peak of overlapping intervals; the state is the level, the peak and the ends to come."""
    found = _in_four_parts(spark, _samples(spark, sf_dir), peaks("value"))
    return peaks_so_far(found, "value").select(F.col("name").alias("value"), F.col("peak").alias("max_in_flight"))
