import datetime
import random

import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F

from bulkflow.operators import monitor, timeline
from bulkflow.session import delete_dir, fresh_dir, list_dirs, make_dir
from bulkflow.streaming import eventtime as et

START = datetime.datetime(2024, 5, 1, 12, 0, 0)
SAMPLES = "sample_id bigint, ts timestamp_ntz, source string, value string, err string, duration double, changed boolean"


def samples(n=300, seed=1):
    r = random.Random(seed)
    return [
        (k, START + datetime.timedelta(milliseconds=r.randrange(40_000)), r.choice(["a", "b", None]), r.choice(["v1", "v1", "v2", "", None]),
         r.choice([None, None, "timeout"]), r.choice([0.0, 0.25, 1.5, 3.0, None]), r.random() < 0.5)
        for k in range(n)
    ]


def arrivals(rows, parts, lateness, seed=2):
    """The rows in ``parts`` by time of arrival, each up to ``lateness`` seconds after its event."""
    r = random.Random(seed)
    due = sorted(rows, key=lambda x: x[1] + datetime.timedelta(seconds=r.random() * lateness))
    return [due[k * len(due) // parts : (k + 1) * len(due) // parts] for k in range(parts)]


def run(spark, parts, schema, handle, delay, close=True):
    inbox, progress = make_dir(spark, fresh_dir(spark, "inbox")), fresh_dir(spark, "progress")
    kind = spark.createDataFrame([], schema).schema
    stream = et.EventTime(spark, fresh_dir(spark, "et"), kind, delay_seconds=delay)
    for n, part in enumerate(parts):
        spark.createDataFrame(part, kind).coalesce(1).write.parquet(f"{inbox}/{n}")
        stream.run(spark.readStream.schema(kind).option("recursiveFileLookup", True).parquet(inbox), progress, handle)
    if close:
        stream.close(handle)
    return stream


def by_row(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3])
def test_ticks_are_those_of_all_samples(spark, parts):
    rows = samples()
    found = run(spark, arrivals(rows, parts, 5), SAMPLES, et.closed_ticks, delay=6)
    whole = spark.createDataFrame(rows, SAMPLES)
    assert found.late().count() == 0 and found.held_back().count() == 0
    assert by_row(found.result("ticks", et.TICKS)) == by_row(monitor.tumbling_stats(whole).select("tick", "success", "errors", "changed", "p90"))


def test_late_and_undated_samples_are_kept_aside(spark):
    rows = samples(200)
    parts = arrivals(rows, 4, 0)
    late = [x for x in parts[0] if x[0] % 5 == 0]
    undated = [(900, None, "a", "v1", None, 1.0, False)]
    parts[0] = [x for x in parts[0] if x[0] % 5]
    parts[3] = parts[3] + late + undated
    found = run(spark, parts, SAMPLES, et.closed_ticks, delay=1)
    aside = {x.sample_id for x in found.late().collect()}
    assert aside == {x[0] for x in late + undated}
    ticks = found.result("ticks", et.TICKS)
    on_time = spark.createDataFrame([x for x in rows if x[0] not in aside], SAMPLES)
    assert by_row(ticks) == by_row(monitor.tumbling_stats(on_time).select("tick", "success", "errors", "changed", "p90"))
    both = ticks.agg(F.sum(F.col("success") + F.col("errors"))).first()[0] + found.late().count()
    assert both == len(rows) + len(undated)


def test_what_is_held_back_is_bounded_by_the_delay(spark):
    rows = samples(400)
    found = run(spark, arrivals(rows, 4, 0), SAMPLES, et.closed_ticks, delay=2, close=False)
    newest = max(x[1] for x in rows)
    held = [x.ts for x in found.held_back().collect()]
    assert held and min(held) >= newest - datetime.timedelta(seconds=3)
    assert all(len(list_dirs(spark, folder)) <= 2 for folder in list_dirs(spark, f"{found.path}/state"))


def test_a_repeated_batch_and_a_stream_that_goes_on(spark):
    rows = samples(200)
    parts = arrivals(rows, 3, 2)
    found = run(spark, parts[:2], SAMPLES, et.closed_ticks, delay=3)  # closed too early
    kind = found.schema
    last = spark.createDataFrame(parts[2], kind)
    for _ in range(2):  # the third micro-batch, and once more after a failure
        found._turn(last, 2, et.closed_ticks)
    delete_dir(spark, f"{found.path}/state/clock/batch=2")
    found._turn(last, 2, et.closed_ticks)
    found.close(et.closed_ticks)
    whole = monitor.tumbling_stats(spark.createDataFrame(rows, SAMPLES)).select("tick", "success", "errors", "changed", "p90")
    assert by_row(found.result("ticks", et.TICKS)) == by_row(whole)


@pytest.mark.parametrize("parts", [1, 4])
def test_baselines_do_not_depend_on_batches(spark, parts):
    rows = samples(250, 3)
    found = run(spark, arrivals(rows, parts, 6, seed=parts), SAMPLES, et.changes_against_first(["source"], "sample_id"), delay=7)
    good = [x for x in rows if x[3] and x[4] is None]
    first = {}
    for x in sorted(good, key=lambda x: (x[1], x[0])):
        first.setdefault(x[2], x[3])
    changes = found.result("changes", found.schema.add("baseline", "string"))
    assert by_row(changes.select("sample_id", "baseline")) == sorted(((x[0], first[x[2]]) for x in good if x[3] != first[x[2]]), key=repr)


EVENTS = "event_id bigint, ts timestamp_ntz, flow string, item string, event_type string"


def events(n=300, seed=5):
    r = random.Random(seed)
    kinds = ["START", "END", "COMMIT"]
    return [(k, START + datetime.timedelta(milliseconds=r.randrange(60_000) // 500 * 500), r.choice("xy"), r.choice(["t", None, "u"]), r.choice(kinds)) for k in range(n)]


@pytest.mark.parametrize("parts", [1, 4])
def test_pairs_are_those_of_all_events(spark, parts):
    rows = events()
    found = run(spark, arrivals(rows, parts, 4), EVENTS, et.paired_events("event_id"), delay=5)
    pairs = found.result("pairs", "flow string, item string, start timestamp_ntz, end timestamp_ntz")
    expected = by_row(timeline.segments(spark.createDataFrame(rows, EVENTS), "event_id"))
    assert by_row(pairs) == expected and len(expected) > 50


def test_an_open_start_is_given_up(spark):
    at = lambda s: START + datetime.timedelta(seconds=s)
    parts = [[(1, at(0), "x", "t", "START"), (2, at(1), "y", "t", "START")], [(3, at(20), "y", "t", "END")], [(4, at(60), "x", "t", "END")]]
    found = run(spark, parts, EVENTS, et.paired_events("event_id", timeout_seconds=30), delay=0)
    pairs = found.result("pairs", "flow string, item string, start timestamp_ntz, end timestamp_ntz")
    assert rows_of(pairs.select("flow")) == [("y",)]
    expired = found.result("expired", "flow string, item string, event_type string, ts timestamp_ntz, event_id bigint")
    assert rows_of(expired.select("event_id")) == [(1,)]


@pytest.mark.parametrize("parts", [1, 4])
def test_peaks_are_those_of_all_intervals(spark, parts):
    rows = samples(250, 8)
    found = run(spark, arrivals(rows, parts, 3), SAMPLES, et.peaks("source"), delay=4)
    whole = monitor.concurrency(spark.createDataFrame(rows, SAMPLES), group=["source"])
    assert by_row(et.peaks_so_far(found, "source").select("name", "peak")) == by_row(whole)
    assert {x.level for x in et.peaks_so_far(found, "source").collect()} != set()


def test_a_group_without_overlaps_peaks_at_0(spark):
    rows = [(1, START, "a", "v", None, 0.0, False), (2, START, "b", "v", None, None, False), (3, START, "c", "v", None, 2.0, False)]
    found = run(spark, [rows], SAMPLES, et.peaks("source"), delay=0)
    assert dict(et.peaks_so_far(found, "source").select("name", "peak").collect()) == {"a": 0, "b": 0, "c": 1}
    whole = spark.createDataFrame([*rows, (4, None, "d", "v", None, 1.0, False)], SAMPLES)
    assert dict(monitor.concurrency(whole, group=["source"]).collect()) == {"a": 0, "b": 0, "c": 1, "d": 0}


def test_an_empty_stream(spark):
    found = run(spark, [[]], SAMPLES, et.closed_ticks, delay=1)
    assert found.result("ticks", et.TICKS).count() == 0 and found.late().count() == 0
    assert et.EventTime(spark, fresh_dir(spark, "none"), found.schema).held_back().count() == 0
    assert et.peaks_so_far(et.EventTime(spark, fresh_dir(spark, "none"), found.schema), "source").count() == 0
