import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F

from bulkflow.functions import parse
from bulkflow.operators import monitor
from bulkflow.plans.publish import Snapshot
from bulkflow.session import fresh_name
from bulkflow.streaming import ingest
from bulkflow.streaming import monitor as stream_monitor

SCHEMA = "sample_id bigint, ts timestamp_ntz, worker bigint, value string, err string, changed boolean, duration double, congestion int"


def sample_rows(spark, n):
    return spark.range(n).select(
        F.col("id").alias("sample_id"),
        F.timestamp_add("MICROSECOND", F.col("id") * 130_000, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 3).alias("worker"),
        F.when(F.col("id") % 11 == 0, "").when(F.col("id") > n / 2, "v2").otherwise("v1").alias("value"),
        F.when(F.col("id") % 7 == 0, "timeout").alias("err"),
        (F.col("id") > n / 2).alias("changed"),
        ((F.col("id") * 37) % 101 / 7).alias("duration"),
        F.lit(1).alias("congestion"),
    )


def test_tick_stream_equals_batch(spark, tmp_path):
    data = sample_rows(spark, 400)
    folder = str(tmp_path / "in")
    for part in range(4):
        data.filter(F.col("sample_id").between(part * 100, part * 100 + 99)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    stream_monitor.write_tick_counts(stream, str(tmp_path / "cp"), out)
    got = stream_monitor.tick_stats(spark, out)
    expected = monitor.tumbling_stats(data).select(*got.columns)
    assert got.count() == expected.count() > 40
    assert rows_of(got, "tick") == rows_of(expected, "tick")
    # A late sample is counted in its old tick.
    data.limit(1).write.mode("append").parquet(folder)
    stream_monitor.write_tick_counts(stream, str(tmp_path / "cp"), out)
    again = monitor.tumbling_stats(data.union(data.limit(1))).select(*got.columns)
    assert rows_of(stream_monitor.tick_stats(spark, out), "tick") == rows_of(again, "tick")


def test_change_stream_equals_batch(spark, tmp_path):
    data = sample_rows(spark, 300)
    folder = str(tmp_path / "in")
    for part in range(3):
        data.filter(F.col("sample_id").between(part * 100, part * 100 + 99)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    stream_monitor.write_changes(stream, str(tmp_path / "cp"), out)
    got = spark.read.parquet(out + "/changes")
    base = monitor.baseline(data, ["ts", "sample_id"]).first()[0]
    expected = monitor.flag_changes(data.filter(~monitor.is_error()), F.lit(base)).filter("changed")
    assert base == "v1" and got.count() == expected.count() > 0
    assert rows_of(got.select("sample_id"), "sample_id") == rows_of(expected.select("sample_id"), "sample_id")


PARSERS = {"ID": parse.parse_int, "NAME": parse.parse_nullable_string}


def test_ingest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,NAME\n1,Alice\n2,\n")
    (folder / "b.csv").write_text("ID,NAME\n3,Carol\n")
    snapshot = Snapshot(spark, fresh_name("ing"))
    run = lambda: ingest.ingest(
        ingest.read_csv_stream(spark, str(folder), ["ID", "NAME"], max_files=1),
        PARSERS, str(tmp_path / "stage"), str(tmp_path / "cp"), snapshot,
    )
    assert run() == 3
    (folder / "c.csv").write_text("ID,NAME\n4,Dan\n")
    assert run() == 4
    assert rows_of(snapshot.read().select("ID", "NAME"), "ID") == [(1, "Alice"), (2, None), (3, "Carol"), (4, "Dan")]
    (folder / "d.csv").write_text("ID,NAME\nbad,Eve\n")
    with pytest.raises(Exception, match="could not be converted"):
        run()
    assert snapshot.read().count() == 4


def test_ingest_checks_the_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,OTHER\n1,Alice\n")
    snapshot = Snapshot(spark, fresh_name("ing"))
    with pytest.raises(Exception):
        ingest.ingest(
            ingest.read_csv_stream(spark, str(folder), ["ID", "NAME"]),
            PARSERS, str(tmp_path / "stage"), str(tmp_path / "cp"), snapshot,
        )


def test_ingest_checks_the_number_of_fields(spark, tmp_path):
    folder = tmp_path / "ragged"
    folder.mkdir()
    (folder / "one.csv").write_text("a,b\n1,x\n2\n")
    stream = ingest.read_csv_stream(spark, str(folder), ["a", "b"])
    snapshot = Snapshot(spark, fresh_name("ragged"))
    parsers = {"a": parse.parse_int, "b": parse.parse_string}
    with pytest.raises(Exception, match="wrong number of fields"):
        ingest.ingest(stream, parsers, str(tmp_path / "staging"), str(tmp_path / "progress"), snapshot)


def test_an_empty_folder_publishes_no_rows(spark, tmp_path):
    folder = tmp_path / "arrivals"
    folder.mkdir()
    snapshot = Snapshot(spark, fresh_name("late"))
    parsers = {"a": parse.parse_int, "b": parse.parse_string}

    def run():
        stream = ingest.read_csv_stream(spark, str(folder), ["a", "b"], max_files=1)
        return ingest.ingest(stream, parsers, str(tmp_path / "staging"), str(tmp_path / "progress"), snapshot)

    assert run() == 0 and snapshot.read().columns == ["a", "b"]
    total = 0
    for n in range(3):
        (folder / f"{n}a.csv").write_text("a,b\n1,x\n2,y\n")
        (folder / f"{n}b.csv").write_text("a,b\n3,z\n")
        total += 3
        assert run() == total and snapshot.read().count() == total
    assert run() == total
