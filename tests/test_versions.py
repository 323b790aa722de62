from concurrent.futures import ThreadPoolExecutor

import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F

from bulkflow.operators.merge import keep_last, upsert
from bulkflow.plans import ledger, load, tables
from bulkflow.plans.partitions import PartitionedTable
from bulkflow.plans.publish import ABTable, Snapshot
from bulkflow.plans.versions import Conflict, Reference, Refused, VersionedTable, content_digest
from bulkflow.session import children, fresh_dir, fresh_name, fresh_table_dir, list_dirs, rename_new


def rows(spark, n, start=0, value="v"):
    return spark.range(start, start + n).select("id", F.concat(F.lit(value), F.col("id")).alias("text"))


def stored(spark, df, **settings):
    t = VersionedTable(spark, fresh_table_dir(spark, "versioned"), **settings).create(df.schema)
    t.append(df)
    return t


def names(t, version=None):
    return {r.file for r in t.files(version).collect()}


def test_versions_and_old_readers(spark):
    t = stored(spark, rows(spark, 10))
    old = t.read()
    t.append(rows(spark, 5, 10))
    t.truncate()
    t.append(rows(spark, 2, 100))
    assert t.version() == 4 and rows_of(t.read().select("id"), "id") == [(100,), (101,)]
    assert old.count() == 10 and t.read(2).count() == 15 and t.read(3).count() == 0
    t.replace(rows(spark, 3))
    assert t.row_count() == 3 and t.row_count(2) == 15
    with pytest.raises(FileExistsError):
        t.create(t.schema())
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, fresh_table_dir(spark, "none")).read()
    for bad in ({"keys": ["nope"]}, {"partition": "nope"}, {"unique": True}):
        with pytest.raises(ValueError):
            VersionedTable(spark, fresh_table_dir(spark, "bad"), **bad).create(t.schema())


def test_an_empty_table(spark):
    empty = rows(spark, 0)
    t = stored(spark, empty, keys=["id"], unique=True)
    assert t.read().count() == 0 and t.read().schema == t.schema() and t.row_count() == 0
    t.merge(empty)
    t.merge(rows(spark, 3))
    t.append(empty)
    assert rows_of(t.read().select("id"), "id") == [(0,), (1,), (2,)]
    assert t.vacuum(grace_seconds=0) >= 0 and t.row_count() == 3


def test_a_merge_rewrites_only_files_with_a_matched_key(spark):
    t = stored(spark, rows(spark, 1000), keys=["id"], rows_per_file=10)
    before = names(t)
    assert len(before) >= 100
    feed = spark.createDataFrame([(5, "new"), (6, "old"), (6, "new"), (2000, "added"), (None, "anonymous")], "id long, text string").withColumn("n", F.monotonically_increasing_id())
    t.merge(feed, ["n"], distinct_order=True)
    after = names(t)
    assert len(before - after) == 1 and len(after - before) >= 1
    got = {(r.id, r.text) for r in t.read().filter("id < 10 or id > 999 or id is null").collect()}
    assert got == {(n, f"v{n}") for n in (0, 1, 2, 3, 4, 7, 8, 9)} | {(5, "new"), (6, "new"), (2000, "added"), (None, "anonymous")}
    assert t.row_count() == 1002
    assert t.read().filter("id between 10 and 999").count() == 990


def test_a_merge_reads_only_files_within_the_feeds_bounds(spark):
    t = stored(spark, rows(spark, 1000), keys=["id"], rows_per_file=10)
    opened = []
    read = t._read_files
    t._read_files = lambda found: opened.append(len(found)) or read(found)
    t.merge(rows(spark, 10, 500, "w"))
    assert max(opened) <= 2


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_upsert(spark, seed):
    target = spark.range(400).select((F.floor(F.rand(seed) * 300)).alias("id"), F.floor(F.rand(seed + 9) * 4).alias("k"), F.rand(seed).cast("string").alias("text"))
    target = spark.createDataFrame(target.collect(), target.schema)
    feed = spark.range(90).select((F.floor(F.rand(seed + 1) * 400)).alias("id"), F.floor(F.rand(seed + 7) * 4).alias("k"), F.lit("new").alias("text"), F.col("id").alias("n"))
    feed = spark.createDataFrame(feed.collect(), feed.schema)
    t = stored(spark, target, keys=["id", "k"], rows_per_file=7)
    t.merge(feed, ["n"])
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted(map(tuple, upsert(target, feed, ["id", "k"], ["n"]).collect()), key=repr)


def test_writers_that_race_lose_nothing(spark):
    t = stored(spark, rows(spark, 10))
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda n: t.append(rows(spark, 10, 100 * n)), range(1, 6)))
    assert t.version() == 6 and t.row_count() == 60 and t.read().select("id").distinct().count() == 60


def racing(t, during):
    """Let ``during`` commit once, just before the next version is taken."""
    take, done = t._take, []

    def slow(version, entries):
        if not done:
            done.append(1)
            during()
        return take(version, entries)

    t._take = slow


def test_a_merge_notices_what_others_did(spark):
    t = stored(spark, rows(spark, 100), keys=["id"], rows_per_file=10)
    other = VersionedTable(spark, t.path, keys=["id"], rows_per_file=10)
    written = []
    write = t._write
    t._write = lambda df: written.append(1) or write(df)
    racing(t, lambda: other.append(rows(spark, 10, 1000)))
    t.merge(rows(spark, 5, 0, "w"))
    assert len(written) == 1 and t.row_count() == 110  # the other's rows do not concern it
    racing(t, lambda: other.merge(rows(spark, 1, 2, "x")))
    t.merge(rows(spark, 1, 3, "y"))
    assert len(written) == 3  # the other rewrote the same file: start again
    got = dict(t.read().filter("id < 6").collect())
    assert got == {0: "w0", 1: "w1", 2: "x2", 3: "y3", 4: "w4", 5: "v5"} and t.row_count() == 110
    racing(t, lambda: other.append(rows(spark, 1, 5000, "first")))
    t.merge(rows(spark, 1, 5000, "second"))
    assert rows_of(t.read().filter("id = 5000")) == [(5000, "second5000")]


def test_giving_up(spark):
    t = stored(spark, rows(spark, 1))
    t._take = lambda version, entries: False
    for change in (lambda: t.append(rows(spark, 1)), t.truncate):
        with pytest.raises(Conflict):
            change()
    assert t.row_count() == 1


def test_a_name_is_taken_once(spark):
    base = fresh_dir(spark, "rename")
    made = [rows(spark, 1).write.parquet(f"{base}/{n}") or f"{base}/{n}" for n in "abcd"]
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda p: rename_new(spark, p, f"{base}/target"), made))
    assert sum(taken) == 1 and len(list_dirs(spark, base)) == 4
    with pytest.raises(Exception):
        rename_new(spark, f"{base}/absent", f"{base}/other")


def daily(spark, **settings):
    df = spark.createDataFrame(
        [(n, d) for n, d in enumerate(["P_INITIAL", "P_UNDATED", "2024-01-01", "2024-01-02", "2024-01-02", "odd /=%é", "2024-01-03"])], "id long, day string"
    )
    return df, stored(spark, df, keys=["id"], partition="day", **settings)


def test_partitions_change_in_one_version(spark):
    df, t = daily(spark)
    assert rows_of(t.partitions().select("partition", "row_count", "low", "high"), "partition") == [
        ("2024-01-01", 1, 2, 2), ("2024-01-02", 2, 3, 4), ("2024-01-03", 1, 6, 6), ("P_INITIAL", 1, 0, 0), ("P_UNDATED", 1, 1, 1), ("odd /=%é", 1, 5, 5),
    ]
    assert t.read().columns == ["id", "day"] and t.read().count() == 7
    assert rows_of(t.read_partitions(["2024-01-02", "odd /=%é"]), "id") == [(3, "2024-01-02"), (4, "2024-01-02"), (5, "odd /=%é")]
    t.drop_partitions(["odd /=%é", "absent"])
    before = t.version()
    assert t.retain_latest() == before + 1
    assert {r.day for r in t.read().collect()} == {"P_INITIAL", "P_UNDATED", "2024-01-03"}
    t.rolling_replace(spark.createDataFrame([(9, "2024-01-09")], df.schema))
    assert {r.day for r in t.read().collect()} == {"P_INITIAL", "P_UNDATED", "2024-01-09"} and t.version() == before + 2
    t.replace_partition("2024-01-09", spark.createDataFrame([(10, "2024-01-09"), (11, "2024-01-09")], df.schema))
    assert t.read().count() == 4
    with pytest.raises(Refused):
        t.replace_partition("2024-01-09", spark.createDataFrame([(1, "2024-01-08")], df.schema))
    with pytest.raises(Exception, match="no partition"):
        t.append(spark.createDataFrame([(1, None)], df.schema))
    assert t.read().count() == 4


def test_retention_races_with_an_append(spark):
    df, t = daily(spark)
    t.drop_partitions(["odd /=%é"])
    other = VersionedTable(spark, t.path, keys=["id"], partition="day")
    racing(t, lambda: other.append(spark.createDataFrame([(50, "2024-02-01")], df.schema)))
    t.retain_latest()
    assert {r.day for r in t.read().collect()} == {"P_INITIAL", "P_UNDATED", "2024-02-01"}


def test_exchange(spark):
    _, t = daily(spark)
    staging = stored(spark, spark.createDataFrame([(70,), (71,)], "id long"))
    t.exchange("2024-01-02", staging)
    assert rows_of(t.read_partitions(["2024-01-02"]).select("id"), "id") == [(70,), (71,)] and rows_of(staging.read(), "id") == [(3,), (4,)]
    with pytest.raises(ValueError):
        t.exchange("2024-01-02", stored(spark, spark.createDataFrame([("x",)], "id string")))


def test_keys_and_references_are_enforced(spark):
    parents = rows(spark, 20)
    t = VersionedTable(spark, fresh_table_dir(spark, "keys"), keys=["id"], unique=True, references=[Reference("parent", lambda: parents, "id")])
    t.create(spark.createDataFrame([], "id long, parent long").schema)

    def batch(*values):
        return spark.createDataFrame(list(values), "id long, parent long")

    t.append(batch((1, 1), (2, None), (3, 19)))
    for bad, why in ((batch((4, 1), (4, 2)), "more than once"), (batch((5, 1), (2, 1)), "already"), (batch((6, 20)), "no parent"), (batch((None, 1)), "must not be null")):
        with pytest.raises(Refused, match=why):
            t.append(bad)
    assert t.row_count() == 3 and t.version() == 1
    other = VersionedTable(spark, t.path, keys=["id"], unique=True)
    racing(t, lambda: other.append(batch((7, 1))))
    with pytest.raises(Refused, match="already"):
        t.append(batch((7, 2)))
    assert t.row_count() == 4


def test_digests_find_one_changed_cell(spark):
    df = rows(spark, 200).withColumn("maybe", F.when(F.col("id") % 3 == 0, F.col("id")))
    t = stored(spark, df.filter("id < 90"), keys=["id"], rows_per_file=20)
    t.append(df.filter("id >= 90"))

    def whole(found):
        return found.agg(F.count(F.lit(1)), content_digest(found)).first()

    assert tuple(t.digest().first()) == tuple(whole(df.repartition(7)))
    assert whole(df.select("maybe", "text", "id")) == whole(df)
    for changed in (df.withColumn("text", F.when(F.col("id") == 7, "other").otherwise(F.col("text"))), df.withColumn("maybe", F.when(F.col("id") != 9, F.col("maybe")))):
        assert whole(changed) != whole(df) and whole(changed)[0] == 200
    swapped = spark.createDataFrame([(1, None), (None, 1)], "a long, b long")
    assert whole(swapped) != whole(spark.createDataFrame([(1, None), (1, None)], "a long, b long"))
    t.merge(df.filter("id = 5").withColumn("text", F.lit("new")))
    assert tuple(t.digest().first()) == tuple(whole(t.read()))


def test_vacuum_keeps_what_kept_versions_name(spark):
    t = stored(spark, rows(spark, 100), keys=["id"], rows_per_file=10)
    for n in range(4):
        t.merge(rows(spark, 1, 0, str(n)))
    t._write(rows(spark, 5))  # a writer that failed before its version
    assert t.vacuum(keep=2, grace_seconds=3600) == 0
    t.merge(rows(spark, 1, 0, "last"))
    named = names(t) | names(t, t.version() - 1)
    assert t.vacuum(keep=2, grace_seconds=0) > 0
    assert t.read().count() == t.read(t.version() - 1).count() == 100
    left = {f"{r.path.rsplit('/', 2)[1]}/{r.path.rsplit('/', 2)[2]}" for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{t.path}/data").select("path").collect()}
    assert left == named and len(list_dirs(spark, f"{t.path}/versions")) == 2
    with pytest.raises(ValueError):
        t.vacuum(keep=0)


def test_csv_into_a_versioned_table(spark, tmp_path):
    t = stored(spark, spark.createDataFrame([(1, "a"), (2, "b")], "ID long, NAME string"), keys=["ID"])
    path = tmp_path / "feed.csv"
    path.write_text("id,name\nNUMBER,VARCHAR2\n2,first\n3,c\n2,last\n")
    assert load.upsert_csv(spark, str(path), t, ["id"]) == 3
    assert rows_of(t.read(), "ID") == [(1, "a"), (2, "last"), (3, "c")]
    with pytest.raises(ValueError, match="keyed by"):
        load.upsert_csv(spark, str(path), t, ["name"])


def test_keep_last_by_a_distinct_order_does_not_sort(spark):
    feed = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("text"), F.col("id").alias("n"))
    last = keep_last(feed, ["k"], ["n"], distinct_order=True)
    assert rows_of(last, "k") == [(k, str(max(n for n in range(1000) if n % 7 == k))) for k in range(7)]
    target = spark.createDataFrame([(0, "x"), (9, "y")], "k long, text string")
    plan = upsert(target, feed, ["k"], ["n"], distinct_order=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert rows_of(upsert(target, feed, ["k"], ["n"], distinct_order=True), "k") == rows_of(upsert(target, feed, ["k"], ["n"]), "k")


# -- folders and their owners --------------------------------------------------------------


def name(label):
    return fresh_name(label)[:26]


def swept(spark, path):
    return any(f"/{g}" in path for g in ledger.vacuum(spark, grace_seconds=0))


def test_truncated_partitions_do_not_come_back(spark):
    t = PartitionedTable(spark, name("t")).create(spark.createDataFrame([], "id long, _part string").schema)
    t.append(spark.createDataFrame([(1, "x"), (2, "y")], "id long, _part string"))
    old = tables.location(spark, t.name)
    tables.truncate(spark, t.name)
    assert t.read().count() == 0 and t.values() == []
    t.append(spark.createDataFrame([(3, "x")], "id long, _part string"))
    assert rows_of(t.read()) == [(3, "x")]
    assert ledger.owners(spark, old) == [] and swept(spark, old)
    assert rows_of(t.read()) == [(3, "x")] and not children(spark, old)


def test_what_has_an_owner_stays(spark):
    df = rows(spark, 5)
    plain, pair, shown, second = name("p"), ABTable(spark, name("ab")), Snapshot(spark, name("s")), Snapshot(spark, name("s2"))
    tables.create_or_replace(spark, plain, df.schema)
    tables.append(df, plain)
    for _ in range(3):
        pair.swap(df, drop_old=True)
        shown.publish(df)
    second.adopt(shown.path())
    failed, _ = tables.write_fresh(df, "failed")
    versioned = stored(spark, df)
    assert ledger.owners(spark, shown.path()) == sorted([shown.name, second.name])
    assert ledger.vacuum(spark, grace_seconds=3600) == []
    assert swept(spark, failed)
    assert versioned.read().count() == 5
    for n in (plain, pair.name, shown.name, second.name):
        assert spark.table(n).count() == 5
    location = tables.location(spark, plain)
    tables.drop(spark, plain)
    assert ledger.owners(spark, location) == [] and not children(spark, location)


def test_exchanged_folders_have_both_owners(spark):
    schema = "id long, _part string"
    t, staging = PartitionedTable(spark, name("m")), name("st")
    t.create(spark.createDataFrame([], schema).schema)
    t.append(spark.createDataFrame([(1, "x"), (2, "y")], schema))
    t.load_and_exchange(spark.createDataFrame([(7,)], "id long"), "x", staging)
    ledger.vacuum(spark, grace_seconds=0)
    assert rows_of(t.read(), "id") == [(2, "y"), (7, "x")] and rows_of(spark.table(staging)) == [(1,)]
    assert len(ledger.owners(spark, tables.location(spark, t.name))) == 2  # the table, and the staging table below it
    t.drop_all()
    ledger.vacuum(spark, grace_seconds=0)
    assert t.read().count() == 0 and rows_of(spark.table(staging)) == [(1,)]


def test_a_declared_key_is_enforced_by_appends(spark):
    from bulkflow.functions.types import ColumnDef

    t = name("key")
    tables.create_or_replace(spark, t, [ColumnDef("a", "NUMBER", primary_key=True), ColumnDef("b", "VARCHAR2", primary_key=True), ColumnDef("c", "CLOB")])
    schema = "a int, b string, c string"
    tables.append(spark.createDataFrame([(1, "x", "1"), (1, "y", "2")], schema), t)
    for bad, why in (([(1, "x", "3"), (2, "z", "4")], "already"), ([(5, "q", "1"), (5, "q", "2")], "more than once")):
        with pytest.raises(Exception, match=why):
            tables.append(spark.createDataFrame(bad, schema), t)
    assert tables.append(spark.createDataFrame([(2, "x", "5")], schema), t) == 1
    assert spark.table(t).count() == 3
