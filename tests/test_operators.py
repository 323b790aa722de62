import datetime
import random

import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkflow.functions.types import ColumnDef, struct_type
from bulkflow.operators import audit, monitor, rows, timeline
from bulkflow.operators.ordered import segmented, with_previous, with_running_sum
from workload import row_queries


def test_ordered_with_one_hot_group(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["hot", "hot", "hot", "b", None]), rnd.randrange(500), i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, t int, id int")
    seg = segmented(df, ["g"], ["t", "id"], partitions=7)
    assert seg.filter("g = 'hot'").select("_seg").distinct().count() > 2
    got = {r.id: (r.prev, r.total) for r in with_running_sum(
        with_previous(seg, ["g"], ["t", "id"], {"id": "prev"}), ["g"], ["t", "id"], "t", "total").collect()}
    for g in ("hot", "b", None):
        ordered = sorted([(t, i) for k, t, i in data if k == g])
        before, total = None, 0
        for t, i in ordered:
            total += t
            assert got[i] == (before, total)
            before = i


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 11, 100])
def test_p90(spark, n):
    values = [((i * 37) % 101) / 7 for i in range(n)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "g string, v double")
    got = {r.g: r.p90 for r in monitor.nearest_rank(df, ["g"], "v").collect()}
    expected = {"a": sorted(values)[min(int(n * 0.90), n - 1)]} if n else {}
    assert got == expected
    overall = monitor.nearest_rank(df, [], "v").collect()
    assert [r.p90 for r in overall] == list(expected.values())


def samples(spark, data):
    schema = "sample_id bigint, ts timestamp_ntz, worker bigint, value string, err string, changed boolean, duration double, congestion int"
    ts = lambda ms: f"2024-01-01 00:00:{ms // 1000:02d}.{ms % 1000:03d}"
    raw = spark.createDataFrame(
        [(i, ts(ms), w, v, e, c, float(d), k) for i, (ms, w, v, e, c, d, k) in enumerate(data)],
        "sample_id bigint, ts string, worker bigint, value string, err string, changed boolean, duration double, congestion int",
    )
    return raw.select(*[F.col(f.split()[0]).cast(f.split()[1]).alias(f.split()[0]) for f in schema.split(", ")])


POLLS = [
    (100, 1, "", None, False, 0.1, 1),
    (200, 1, "v1", None, False, 0.2, 2),
    (300, 2, "v1", "timeout", False, 0.9, 3),
    (1200, 1, "v1", None, False, 0.3, 2),
    (1300, 2, "v2", None, True, 0.4, 1),
    (1400, 2, None, None, False, 0.5, 1),
    (2500, 1, "v3", None, True, 0.6, 1),
]


def test_poll_summary(spark):
    s = samples(spark, POLLS)
    r = monitor.poll_summary(s, F.lit(""), ["ts", "sample_id"]).first()
    assert (r.total, r.success, r.errors, r.max_congestion) == (7, 4, 3, 3)
    assert r.p90 == 0.9
    assert str(r.first_change_at) == "2024-01-01 00:00:01.300000" and r.first_change_value == "v2"
    fixed = monitor.first_change(s, F.lit("v2"), ["ts", "sample_id"]).first()
    assert fixed.first_change_value == "v1"
    lag = monitor.change_lag(s, F.lit(""), F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"), ["ts", "sample_id"])
    assert lag.first().lag_seconds == 0.3
    empty = monitor.poll_summary(s.limit(0), F.lit(""), ["ts", "sample_id"]).first()
    assert (empty.total, empty.p90, empty.first_change_at) == (0, 0.0, None)


def test_observation_window(spark):
    s = samples(spark, POLLS)
    at = lambda t: F.lit(f"2024-01-01 00:00:0{t}").cast("timestamp_ntz")
    assert monitor.in_window(s, at(1), at(2)).count() == 3


def test_flag_and_every_change(spark):
    s = samples(spark, POLLS)
    assert rows_of(monitor.flag_changes(s, F.lit("v1")).filter("changed").select("value"), "ts") == [("v2",), ("v3",)]
    assert monitor.flag_changes(s, F.lit("")).filter("changed").count() == 0
    assert monitor.flag_changes(s, F.lit(None).cast("string")).filter("changed").count() == 0
    got = monitor.every_change(s, [], ["ts", "sample_id"])
    assert rows_of(got.select("previous_value", "value"), "ts") == [("v1", "v2"), ("v2", "v3")]


def test_tumbling_stats(spark):
    got = monitor.tumbling_stats(samples(spark, POLLS))
    assert [(str(r.tick)[-1], r.success, r.errors, r.changed, r.p90) for r in got.orderBy("tick").collect()] == [
        ("0", 1, 2, 0, 0.9), ("1", 2, 1, 1, 0.5), ("2", 1, 0, 1, 0.6)
    ]


def test_only_crowded_ticks_are_spread(spark, monkeypatch):
    rnd = random.Random(4)
    start = datetime.datetime(2024, 1, 1)
    at = lambda: rnd.choice([None, start, start + datetime.timedelta(milliseconds=rnd.randrange(6000)), datetime.datetime(1969, 12, 31, 23, 59, 59, 500)])
    data = [(at(), rnd.choice(["v", "w", "", None]), rnd.choice([None, "timeout"]), rnd.choice([None, 0.0, -0.0, float("nan"), rnd.randrange(40) / 7]), rnd.random() < 0.5) for _ in range(600)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, value string, err string, duration double, changed boolean")
    spread = []
    of_histogram = monitor.nearest_rank_of_histogram
    monkeypatch.setattr(monitor, "nearest_rank_of_histogram", lambda *a: spread.append(1) or of_histogram(*a))
    stats = lambda: sorted(map(repr, monitor.tumbling_stats(df).collect()))
    whole = stats()
    assert not spread
    for most in (60, 0):  # some ticks, all ticks
        monkeypatch.setattr(monitor, "CROWD", most, raising=False)
        assert stats() == whole
    assert len(spread) == 2
    second = lambda t: t and t.replace(microsecond=0)
    for r in monitor.tumbling_stats(df).collect():
        timed = sorted((d for t, *_, d, _ in data if second(t) == r.tick and d is not None), key=lambda d: (d != d, d))
        rank = min(int(len(timed) * 0.90), len(timed) - 1)
        assert repr(r.p90) == repr(timed[rank] + 0.0 if timed else None)


def test_concurrency(spark):
    rnd = random.Random(5)
    data = [(rnd.randrange(20000), 1, "v", None, False, rnd.randrange(0, 4000) / 1000, 0) for _ in range(300)]
    data += [(1000, 1, "v", None, False, 1.0, 0), (2000, 1, "v", None, False, 1.0, 0)]
    got = monitor.concurrency(samples(spark, data)).first().max_in_flight
    spans = [(a, a + round(d * 1000)) for a, _, _, _, _, d, _ in data]
    assert got == max(sum(1 for a, b in spans if a <= t < b) for t, _ in spans)
    assert monitor.concurrency(samples(spark, data).limit(0)).first().max_in_flight == 0


def events(spark, data):
    raw = spark.createDataFrame([(i, f, t, k, s) for i, (f, t, k, s) in enumerate(data)], "id int, flow string, item string, event_type string, s double")
    return raw.select("id", "flow", "item", "event_type", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))


FLOW = [
    ("CHAIN", "A", "EXPECTED", 0.0),
    ("CHAIN", "A", "START", 1.0),
    ("CHAIN", "A", "START", 2.0),
    ("CHAIN", "B", "START", 2.5),
    ("CHAIN", "A", "END", 3.0),
    ("CHAIN", "A", "END", 3.5),
    ("EARLY", "A", "END", 4.0),
    ("CHAIN", "B", "EXPECTED", 4.5),
    ("CHAIN", None, "COMMIT", 5.0),
    ("EARLY", None, "ROLLBACK", 6.0),
    ("EARLY", None, "ROLLBACK", 7.0),
    ("EARLY", "C", "START", 8.0),
]


def test_timeline(spark):
    e = events(spark, FLOW)
    sec = lambda t: None if t is None else t.timestamp() % 60
    got = [(r.flow, r.item, r.start.second + r.start.microsecond / 1e6, r.end.second) for r in timeline.segments(e, "id").collect()]
    assert got == [("CHAIN", "A", 2.0, 3)]
    full = timeline.timeline(e, "id")
    assert full.filter("flow = 'CHAIN EXPECTED'").count() == 2 and full.count() == 3
    delays = timeline.expected_vs_actual(e, "id").filter("flow = 'CHAIN'").select("item", "ordinal", "delay_seconds")
    assert rows_of(delays, "item", "ordinal") == [("A", 1, 1.0), ("A", 2, None), ("B", 1, -2.0)]
    s = {r.flow: r for r in timeline.summary(e).collect()}
    assert s["CHAIN"].seconds == 5.0 and s["EARLY"].seconds == 8.0 and s["CHAIN"].rolled_back_at is None
    assert s["EARLY"].rolled_back_at.second == 7
    assert timeline.total_seconds(e).first()[0] == 8.0
    assert {r.flow: r.committed_at is None for r in timeline.outcomes(e).collect()} == {"CHAIN": False, "EARLY": True}


def test_audits(spark):
    t = spark.createDataFrame([(1, "a", 123.456), (1, None, 1e9), (None, "long text", None)], "ID int, NAME string, PRICE double")
    schema = struct_type(
        [ColumnDef("ID", "NUMBER", nullable=False), ColumnDef("NAME", "VARCHAR2", length=4, nullable=False), ColumnDef("PRICE", "NUMBER", precision=5, scale=2)]
    )
    got = rows_of(audit.column_audit(t, schema), "column")
    assert got == [("ID", 1, 0, 0), ("NAME", 1, 1, 0), ("PRICE", 0, 0, 1)]
    assert rows_of(audit.unique_violations(t, ["ID"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    child = spark.createDataFrame([(1,), (2,), (None,)], "ref int")
    assert rows_of(audit.foreign_key_violations(child, "ref", parent, "pid")) == [(2,)]
    stamped = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS at UNION ALL SELECT NULL")
    assert tuple(audit.table_stats(stamped, "at").first()) == (2, "2024-01-01 10:00:00")
    assert audit.freshness(stamped.limit(0), "at").first()[0] == ""
    assert audit.row_count(t).first()[0] == 3
    assert audit.count_after(stamped, "at", F.lit("2023-12-31").cast("timestamp_ntz")).first()[0] == 1
    check = audit.publish_check(stamped, stamped.filter("at is not null"), "at").first()
    assert (check.base_count, check.published_count, check.consistent) == (2, 1, False)
    assert audit.publish_check(stamped, stamped, "at").first().consistent
    assert rows_of(audit.count_pair(t, t.limit(1)), "side") == [("master", 3), ("staging", 1)]


def test_rows(spark):
    t = spark.createDataFrame([(" a ", " "), ("  ", "\t"), ("", None)], "a string, b string")
    assert rows_of(rows.trim_skip_blank(t, ["a", "b"])) == [("a", None)]
    f = spark.createDataFrame([(["1"],), (["1", "2", "3"],), (["", "2"],)], "f array<string>")
    got = f.select(*rows.align(F.col("f"), ["x", "y"]), rows.width_error(F.col("f"), 2).alias("e"))
    assert sorted(rows_of(got), key=str) == sorted([("1", None, "expected 2 values, got 1"), ("1", "2", "expected 2 values, got 3"), (None, "2", None)], key=str)


def test_map_columns(spark):
    schema = T.StructType([T.StructField("Ident", T.IntegerType(), True, {"db": "id"}), T.StructField("id", T.StringType()), T.StructField("Age", T.IntegerType())])
    df = spark.createDataFrame([(7, "other", 30)], schema)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert rows_of(rows.map_columns(df, ["id", "age"])) == [(7, 30)]
        with pytest.raises(ValueError, match="'x' not found"):
            rows.map_columns(df, ["x"])
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_batch_typing(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (0, parse_json('null'), parse_json('1.5'), parse_json('"a"'), parse_json('1'), CAST(NULL AS VARIANT)),
        (1, parse_json('5'), parse_json('2e1'), parse_json('"b"'), parse_json('true'), CAST(NULL AS VARIANT)),
        (2, parse_json('6'), parse_json('3.25'), parse_json('"c"'), parse_json('2'), CAST(NULL AS VARIANT))
        AS t(i, a, b, c, d, e)"""
    )
    got = {r["column"]: r for r in rows.batch_kinds(df, ["a", "b", "c", "d", "e"], ["i"]).collect()}
    assert {k: (r.kind, r.mismatches) for k, r in got.items()} == {
        "a": ("integer", 1), "b": ("float", 0), "c": ("text", 0), "d": ("integer", 1), "e": ("generic", 0)
    }
    assert got["a"].first_mismatch.i == 0 and got["d"].first_mismatch.i == 1
    assert rows_of(rows.bind_batch(df.select("i", "b", "c"), ["b", "c"], ["i"]), "i") == [(0, 1.5, "a"), (1, 20.0, "b"), (2, 3.25, "c")]
    with pytest.raises(ValueError, match="column d holds something else"):
        rows.bind_batch(df, ["b", "d"], ["i"])


def test_a_mixed_column_is_named_with_its_first_odd_row(spark):
    df = spark.sql("SELECT * FROM VALUES (7, parse_json('1')), (8, parse_json('2')), (9, parse_json('\"x\"')) AS t(i, u)")
    with pytest.raises(rows.MixedColumn) as refused:
        rows.bind_batch(df, ["u"], ["i"])
    assert (refused.value.column, refused.value.kind, refused.value.row) == ("u", "integer", (9,))


@pytest.mark.parametrize("odd", [None, 2])
def test_bind_batch_query_gives_the_first_odd_row(spark, tmp_path, odd):
    kind = F.when(F.col("event_id") == odd, "error").otherwise("view")
    events = spark.range(4).select(
        F.col("id").alias("event_id"), F.col("id").alias("user_id"), (F.col("id") / 2).alias("value"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts")
    ).withColumn("event_type", kind)
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = row_queries.bind_batch(spark, str(tmp_path))
    assert rows_of(got.select("event_id", "user", "first_mismatch"), "event_id") == [(i, i, odd) for i in range(4)]
