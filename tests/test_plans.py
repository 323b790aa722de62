import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F

from bulkflow.functions import parse
from bulkflow.functions.types import ColumnDef, primary_key
from bulkflow.plans import load, partitions, tables
from bulkflow.plans.partitions import PartitionedTable, day_partition, second_high_value, second_partition
from bulkflow.plans.publish import ABTable, Snapshot, batch_plan, full_reload
from bulkflow.session import fresh_name
from bulkflow.sources.mapped_csv import MappedCsv, Mapping


def name(label):
    return fresh_name(label)[:28]


def test_create_append_truncate(spark):
    t = name("t")
    columns = [ColumnDef("id", "NUMBER", nullable=False, primary_key=True), ColumnDef("v", "VARCHAR2", length=5)]
    tables.create_or_replace(spark, t, columns)
    assert spark.table(t).columns == ["ID", "V"] and spark.table(t).count() == 0
    assert tables.append(spark.createDataFrame([(1, "a"), (2, None)], "id int, v string"), t) == 2
    assert tables.append(spark.createDataFrame([(3,)], "ID int"), t) == 1
    assert tables.append(spark.createDataFrame([], "ID int"), t) == 0
    reader = spark.table(t)
    assert rows_of(reader, "ID") == [(1, "a"), (2, None), (3, None)]
    tables.truncate(spark, t)
    assert spark.table(t).count() == 0
    with pytest.raises(ValueError, match="has no columns"):
        tables.append(spark.createDataFrame([(1,)], "x int"), t)
    tables.create_or_replace(spark, t, [ColumnDef("other", "CLOB")])
    assert spark.table(t).columns == ["OTHER"]
    for bad in (lambda: tables.create_or_replace(spark, t, []), lambda: tables.create_or_replace(spark, "1x", columns)):
        with pytest.raises(ValueError):
            bad()


def test_append_takes_only_what_the_table_can_hold(spark):
    t = name("strict")
    columns = [
        ColumnDef("id", "NUMBER", nullable=False, primary_key=True), ColumnDef("v", "VARCHAR2", length=3),
        ColumnDef("n", "NUMBER", precision=5, scale=2),
    ]
    tables.create_or_replace(spark, t, columns)
    schema = "id double, v string, n double"
    assert tables.append(spark.createDataFrame([(1.75, "abc", 999.99), (2.5, None, None)], schema), t) == 2
    bad = {(None, "a", 1.0): "must not be null", (3.0, "abcd", 1.0): "at most 3", (3.0, "a", 1234.5): "cannot hold", (3.0, "a", 1.239): "cannot hold"}
    for row, why in bad.items():
        with pytest.raises(Exception, match=why):
            tables.append(spark.createDataFrame([(9.0, "ok", 1.0), row], schema), t)
    with pytest.raises(Exception, match="must not be null"):
        tables.append(spark.createDataFrame([("x",)], "v string"), t)
    assert [(float(r.ID), r.V) for r in spark.table(t).orderBy("ID").collect()] == [(1.75, "abc"), (2.5, None)]
    kept = tables.declared(spark, t)
    assert not kept["ID"].nullable and kept["V"].metadata["length"] == 3 and primary_key(kept) == ["ID"]
    tables.create_or_replace(spark, t, spark.createDataFrame([], "a bigint").schema)
    with pytest.raises(Exception, match="cannot hold 1.75"):
        tables.append(spark.createDataFrame([(1.75,)], "a double"), t)


def test_load_csv_keeps_readers_and_failures_leave_the_table(spark, csv_file):
    t = load.load_csv(spark, csv_file("A\nNUMBER\n1\n2\n", "one.csv"), name("swap"))
    reader = spark.table(t)
    assert reader.count() == 2
    load.load_csv(spark, csv_file("A\nNUMBER\n3\n", "two.csv"), t)
    assert reader.count() == 2 and rows_of(spark.table(t)) == [(3,)]
    with pytest.raises(ValueError):
        load.load_csv(spark, csv_file("A\nNUMBER\nx\n", "three.csv"), t)
    assert rows_of(spark.table(t)) == [(3,)]
    load.load_csv(spark, csv_file("A,B\nNUMBER,CLOB\n4,x\n", "four.csv"), t)
    assert rows_of(spark.table(t)) == [(4, "x")]


def test_load_csv(spark, csv_file):
    path = csv_file("ID, Full Name\nNUMBER,VARCHAR2\n1,Alice\n2,\n", "people list.csv")
    assert load.table_name(path) == "PEOPLE_LIST"
    t = load.load_csv(spark, path, name("people"))
    assert rows_of(spark.table(t), "ID") == [(1, "Alice"), (2, None)]
    empty = load.load_csv(spark, csv_file("A\nDATE\n", "e.csv"), name("empty"))
    assert spark.table(empty).dtypes == [("A", "timestamp_ntz")] and spark.table(empty).count() == 0
    with pytest.raises(ValueError, match="row 3 col 1"):
        load.load_csv(spark, csv_file("A\nNUMBER\nx\n", "bad.csv"), t)
    assert spark.table(t).count() == 2
    assert load.table_name(path, "my schema.stg-1") == "MY_SCHEMA.STG_1"


def test_snapshot_readers_keep_old_rows(spark):
    s = Snapshot(spark, name("snap"), keep=2)
    s.publish(spark.range(10).toDF("id"))
    reader = s.read()
    assert reader.count() == 10
    report = s.publish(spark.range(25).toDF("id"))
    assert report.rows == 25 and report.total_seconds > 0
    assert reader.count() == 10 and s.read().count() == 25
    old = s.path()
    s.publish(spark.range(3).toDF("id"))
    s.publish(spark.range(4).toDF("id"))
    with pytest.raises(Exception):
        reader.count()
    assert spark.read.parquet(s.path()).count() == 4 and old != s.path()


def test_snapshot_survives_failures(spark):
    s = Snapshot(spark, name("snap"))
    s.publish(spark.range(10).toDF("id"))
    with pytest.raises(Exception, match="boom"):
        s.publish(spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")))
    with pytest.raises(RuntimeError, match="expected 6"):
        s.switch(s.stage(spark.range(5).toDF("id"))[0], 6)
    assert s.read().count() == 10


def test_snapshot_projection(spark):
    s = Snapshot(spark, name("proj"), columns=["id"])
    s.publish(spark.range(3).withColumn("x", F.lit(1)))
    assert s.read().columns == ["id"]
    s.publish(spark.range(0).withColumn("x", F.lit(1)))
    assert s.read().count() == 0


def test_reload_keeps_the_files_a_stuck_publication_reads(spark):
    class Stuck(Snapshot):
        def adopt(self, path):
            raise RuntimeError("catalog is away")

    base, mv = Snapshot(spark, name("base"), keep=1), Snapshot(spark, name("mv"))
    full_reload(Rows(spark.range(3)), base, ["id"], mv)
    for n in (4, 5, 6):
        with pytest.raises(RuntimeError, match="away"):
            full_reload(Rows(spark.range(n)), base, ["id"], Stuck(spark, mv.name))
        assert mv.read().count() == 3 and base.read().count() == n
    full_reload(Rows(spark.range(7)), base, ["id"], mv)
    assert mv.read().count() == 7 and base._history() == [base.path()]


def test_a_published_copy_outlives_two_versions_of_its_base(spark):
    base, mv = Snapshot(spark, name("base")), Snapshot(spark, name("mv"))
    report = full_reload(Rows(spark.range(4)), base, ["id"], mv)
    shown = mv.path()
    for n in (5, 6, 7):
        base.publish(spark.range(n).toDF("id"))
    assert mv.read().count() == 4 and base.read().count() == 7
    mv.adopt(base.path())
    base.publish(spark.range(8).toDF("id"))
    with pytest.raises(Exception):
        spark.read.parquet(shown).count()  # nobody shows it any more
    assert mv.read().count() == 7
    row = report.to_df(spark).first()
    assert row.rows == 4 and abs(row.insert_seconds + row.commit_seconds + row.refresh_seconds - row.total_seconds) < 1e-6


def test_ab_readers_keep_their_files_over_two_swaps(spark):
    ab = ABTable(spark, name("AB")[:20])
    ab.swap(spark.range(3).toDF("id"))
    reader = spark.table(ab.name)
    assert reader.count() == 3
    ab.swap(spark.range(5).toDF("id"))
    ab.swap(spark.range(7).toDF("id"))
    assert reader.count() == 3 and spark.table(ab.name).count() == 7
    ab.swap(spark.range(2).selectExpr("id", "id * 2 AS twice"))
    assert spark.table(ab.name).columns == ["id", "twice"]


def test_ab_swap(spark):
    ab = ABTable(spark, name("AB")[:20])
    seen = []
    ab.swap(spark.range(3).toDF("id"), on_count=lambda t, n: seen.append((t, n)))
    assert ab.active() == f"{ab.name}_A"
    ab.swap(spark.range(5).toDF("id"), drop_old=True)
    assert ab.active() == f"{ab.name}_B" and spark.table(ab.name).count() == 5
    assert spark.table(f"{ab.name}_A").count() == 0
    ab.swap(spark.range(7).toDF("id"))
    assert ab.active() == f"{ab.name}_A" and spark.table(ab.name).count() == 7
    assert spark.table(f"{ab.name}_B").count() == 5 and seen == [(f"{ab.name}_A", 3)]


class Rows:
    """A source made from a DataFrame."""

    def __init__(self, df, problem=None):
        self.df, self.problem = df, problem

    def validate(self):
        if self.problem:
            raise ValueError(self.problem)

    def rows(self):
        return self.df


def test_full_reload(spark, csv_file):
    base, mv = Snapshot(spark, name("base")), Snapshot(spark, name("mv"), columns=["id"])
    maps = [Mapping("ID", "id", parse.parse_int), Mapping("NAME", "name")]
    source = MappedCsv(spark, csv_file("ID,NAME\n1,a\n2,b\n3,c\n"), maps)
    assert full_reload(source, base, ["id", "name"], mv).rows == 3
    assert rows_of(mv.read(), "id") == [(1,), (2,), (3,)]
    bad = MappedCsv(spark, csv_file("ID,NAME\n1,a\nx,b\n", "bad.csv"), maps)
    with pytest.raises(Exception, match="could not be converted"):
        full_reload(bad, base, ["id", "name"], mv)
    assert base.read().count() == 3 and mv.read().count() == 3
    with pytest.raises(ValueError, match="did not pass its check: nope"):
        full_reload(Rows(spark.range(1), "nope"), base, ["id"], mv)
    with pytest.raises(ValueError, match="no columns to load"):
        full_reload(source, base, [], mv)
    with pytest.raises(ValueError, match="no table to load"):
        full_reload(source, None, ["id"], mv)
    with pytest.raises(ValueError, match="the source has no columns"):
        full_reload(source, base, ["id", "zip"], mv)
    # No rows: nothing to insert, the refresh still happens.
    assert full_reload(Rows(spark.range(0).withColumn("name", F.lit("x"))), base, ["id", "name"], mv).rows == 0
    assert mv.read().count() == 0
    assert mv.path() == base.path()
    # No published name: only the table is replaced.
    full_reload(Rows(spark.range(4)), base, ["id"])
    assert base.read().count() == 4 and mv.read().count() == 0


@pytest.mark.parametrize("n,size,expected", [(5, 2, [2, 2, 1]), (4, 2, [2, 2]), (0, 2, []), (150, 0, [100, 50])])
def test_batch_plan(spark, n, size, expected):
    assert [r.rows for r in batch_plan(spark.range(n), "id", size).orderBy("batch_no").collect()] == expected


def daily(spark):
    t = PartitionedTable(spark, name("daily"))
    data = spark.sql(
        "SELECT id, timestamp_ntz'2023-12-30 12:00:00' + make_dt_interval(cast(id / 2 AS int)) AS at FROM range(12)"
    ).withColumn("_part", day_partition(F.col("at")))
    t.create(data.schema)
    t.append(data)
    return t


def test_routing(spark):
    r = spark.sql("SELECT timestamp_ntz'2024-03-01 23:59:59.7' AS t").select(
        day_partition(F.col("t")), second_partition(F.col("t")), second_high_value(F.col("t"))
    ).first()
    assert tuple(r) == ("2024-03-01", "P_20240301235959", "20240302 00:00:00")


def test_partition_listing_and_retention(spark):
    t = daily(spark)
    assert t.values() == ["P_INITIAL", "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert rows_of(t.listing().select("position", "partition", "row_count"), "position") == [
        (1, "P_INITIAL", 4), (2, "2024-01-01", 2), (3, "2024-01-02", 2), (4, "2024-01-03", 2), (5, "2024-01-04", 2)
    ]
    t.analyze()
    assert rows_of(t.distribution(), "partition")[0] == ("2024-01-01", 12)
    t.truncate_partition("2024-01-02")
    assert t.partition("2024-01-02").count() == 0 and "2024-01-02" in t.values()
    assert {r.partition: r.row_count for r in t.listing().collect()}["2024-01-02"] == 0
    assert t.retain_latest() == 3 and t.values() == ["P_INITIAL", "2024-01-04"]
    assert t.read().count() == 6
    assert t.drop_all() == 1 and t.values() == ["P_INITIAL"] and t.drop_all() == 0
    assert t.read().count() == 4


def test_rows_without_a_day_never_count_as_the_latest(spark):
    t = PartitionedTable(spark, name("undated"))
    rows = spark.sql(
        "SELECT id, CASE WHEN id < 4 THEN timestamp_ntz'2024-05-05 00:00:00' + make_dt_interval(cast(id AS int)) END AS at FROM range(6)"
    )
    routed = rows.withColumn("_part", day_partition(F.col("at")))
    t.create(routed.schema)
    t.append(routed)
    assert t.values() == ["P_UNDATED", "2024-05-05", "2024-05-06", "2024-05-07", "2024-05-08"] and t.latest() == "2024-05-08"
    assert t.retain_latest() == 3 and rows_of(t.read().select("id"), "id") == [(3,), (4,), (5,)]
    with pytest.raises(Exception, match="has no partition"):
        t.append(rows.withColumn("_part", F.date_format("at", "yyyy-MM-dd")))
    assert t.read().count() == 3
    t.rolling_replace(rows.limit(1).withColumn("_part", F.lit("2024-06-01")))
    assert t.values() == ["P_UNDATED", "2024-06-01"]


def test_exchanged_folders_have_one_owner(spark):
    t, staging = daily(spark), name("stg")
    at = F.lit("2024-01-02 08:00:00").cast("timestamp_ntz")
    fresh = spark.range(100, 103).withColumn("at", at)
    t.load_and_exchange(fresh, "2024-01-02", staging)
    t.drop_partition("2024-01-02")
    t.append(spark.range(200, 201).withColumn("at", at).withColumn("_part", F.lit("2024-01-02")))
    assert rows_of(spark.table(staging).select("id"), "id") == [(6,), (7,)]
    assert rows_of(t.partition("2024-01-02").select("id")) == [(200,)]
    t.create(t.read().schema)
    assert t.read().count() == 0 and rows_of(spark.table(staging).select("id"), "id") == [(6,), (7,)]


def test_rolling_replace(spark):
    t = daily(spark)
    new = spark.createDataFrame([(99,)], "id bigint").select(
        "id", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("at"), F.lit("2024-02-01").alias("_part")
    )
    assert t.rolling_replace(new) == 1
    assert t.values() == ["P_INITIAL", "2024-02-01"] and t.read().count() == 5
    with pytest.raises(ValueError):
        t.rolling_replace(new.withColumn("unknown", F.lit(1)))
    assert t.read().count() == 5


def test_rows_of_a_large_partition_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(partitions, "ROWS_PER_TASK", 1000, raising=False)
    wanted = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        t = PartitionedTable(spark, name("dealt"))
        rows = spark.range(10_500).select(
            "id", F.lit("equal").alias("label"), F.create_map(F.lit("k"), "id").alias("more"),
            F.when(F.col("id") < 10_000, "2024-03-01").otherwise("2024-03-02").alias("_part"),
        )
        t.create(rows.schema)
        assert t.append(rows) == 10_500
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = t.read().groupBy("_part", F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 5000
    assert len([r for r in files if r["_part"] == "2024-03-02"]) == 1
    assert t.read().agg(F.count("*"), F.sum("id"), F.sum(F.col("more")["k"])).first()[:] == (10_500, *[10_500 * 10_499 // 2] * 2)


def test_truncate_partitioned_table(spark):
    t = daily(spark)
    tables.truncate(spark, t.name)
    assert t.read().count() == 0 and t.values() == []


def test_exchange(spark):
    t = daily(spark)
    staging = name("stg")
    fresh = spark.createDataFrame([(100,), (101,), (102,)], "id bigint").withColumn(
        "at", F.lit("2024-01-02 08:00:00").cast("timestamp_ntz")
    )
    t.load_and_exchange(fresh, "2024-01-02", staging)
    assert rows_of(t.partition("2024-01-02").select("id"), "id") == [(100,), (101,), (102,)]
    assert rows_of(spark.table(staging).select("id"), "id") == [(6,), (7,)]
    assert t.read().count() == 13
    t.append(fresh.limit(1).withColumn("_part", F.lit("2024-01-02")))
    assert t.partition("2024-01-02").count() == 4 and spark.table(staging).count() == 2
    # Loading the staging table again must not touch what the master reads now.
    t.load_and_exchange(fresh.limit(2), "2024-01-03", staging, drop_old=True)
    assert t.partition("2024-01-02").count() == 4 and t.partition("2024-01-03").count() == 2
    assert spark.table(staging).count() == 0
    # A partition that did not exist, and an empty staging table.
    t.load_and_exchange(fresh.limit(1), "2025-01-01", staging)
    assert t.partition("2025-01-01").count() == 1 and spark.table(staging).count() == 0
    t.load_and_exchange(fresh.limit(0), "2025-01-01", staging)
    assert t.partition("2025-01-01").count() == 0 and spark.table(staging).count() == 1


def test_exchange_validation(spark):
    t = daily(spark)
    staging = name("stg")
    wrong = spark.createDataFrame([(5,)], "id bigint").withColumn("at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    rule = day_partition(F.col("at")) == "2024-01-02"
    with pytest.raises(ValueError, match="do not belong"):
        t.load_and_exchange(wrong, "2024-01-02", staging, rule=rule)
    assert t.partition("2024-01-02").count() == 2 and t.violations(staging, rule).count() == 1
    t.exchange("2024-01-02", staging)
    assert rows_of(t.partition("2024-01-02").select("id")) == [(5,)]
    with pytest.raises(ValueError, match="column mismatch"):
        t.load_and_exchange(wrong.select("id"), "2024-01-02", staging)


def test_exchange_csv(spark, csv_file):
    t = PartitionedTable(spark, name("MASTER"))
    t.create(spark.createDataFrame([], "ID bigint, FIRST_NAME string").schema)
    path = csv_file("ID,FIRST_NAME\nNUMBER,VARCHAR2\n1,ALICE\n2,BOB\n")
    staging = name("STG")
    assert load.exchange_csv(spark, path, t.name, staging, "PDATA", drop_old=True) == 2
    assert rows_of(t.partition("PDATA").select("ID", "FIRST_NAME"), "ID") == [(1, "ALICE"), (2, "BOB")]
    assert spark.table(staging.upper()).count() == 0
    with pytest.raises(ValueError, match="partition is required"):
        load.exchange_csv(spark, path, t.name, staging, " ")


def test_upsert_csv(spark, csv_file, small_splits):
    s = Snapshot(spark, name("target"))
    s.publish(spark.sql("SELECT id AS ID, concat('old', id) AS NAME, 1 AS EXTRA FROM range(50)"))
    lines = "".join(f"{i % 60},new{i}\n" for i in range(120))
    path = csv_file("id,name\nNUMBER,VARCHAR2\n" + lines + ",nokey\n,nokey\n")
    assert load.upsert_csv(spark, path, s, ["id"]) == 122
    got = {r.ID: r for r in s.read().filter("ID is not null").collect()}
    assert len(got) == 60 and all(got[i].NAME == f"new{60 + i}" for i in got)
    assert got[3].EXTRA == 1 and got[55].EXTRA is None
    assert s.read().filter("ID is null").count() == 2
    for keys in ([], ["zip"]):
        with pytest.raises(ValueError):
            load.upsert_csv(spark, path, s, keys)
    assert load.upsert_csv(spark, csv_file("ID,NAME\nNUMBER,CLOB\n", "none.csv"), s, ["ID"]) == 0


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "x"', None), ("", "é", "z")], "a string, b string, c string")
    path = str(tmp_path / "out")
    tables.write_csv(df, path)
    back = spark.read.options(header=True, escape='"').csv(path)
    assert sorted(rows_of(back), key=str) == sorted([("a,b", 'say "x"', None), (None, "é", "z")], key=str)
