import random

import pytest
from row_helpers import rows_of
from pyspark.sql import functions as F

from bulkflow.operators.merge import insert_if_absent, keep_last, last_write_wins, update_all, update_where, upsert


def brute_upsert(target, source, n_keys):
    """Rows are (key..., value); apply the source one by one."""
    rows = [list(r) for r in target]
    for s in source:
        hit = False
        if None not in s[:n_keys]:
            for r in rows:
                if tuple(r[:n_keys]) == tuple(s[:n_keys]):
                    r[n_keys] = s[n_keys]
                    hit = True
        if not hit:
            rows.append([*s[: n_keys + 1], None])
    return sorted((tuple(r) for r in rows), key=str)


def test_upsert_matches_row_by_row(spark):
    rnd = random.Random(7)
    key = lambda: rnd.choice([None, 1, 2, 3, 4, 5])
    target = [(key(), rnd.choice("ab"), rnd.randrange(100), f"keep{i}") for i in range(40)]
    source = [(key(), rnd.choice(["a", "b", "c", None]), rnd.choice([None, 1000 + i]), i) for i in range(60)]
    t = spark.createDataFrame(target, "k int, g string, v int, extra string")
    s = spark.createDataFrame(source, "k int, g string, v int, pos int")
    got = sorted((tuple(r) for r in upsert(t, s, ["k", "g"], order=["pos"]).collect()), key=str)
    # The first unmatched source row of a key inserts it and later ones update that row.
    assert got == brute_upsert(target, source, 2)


def test_upsert_skewed_key_and_null_keys(spark):
    t = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"))
    s = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        F.col("id").alias("pos"),
    )
    got = upsert(t, s, ["k"], order=["pos"])
    assert got.filter("k = 5").collect()[0].v == 29999 - 29999 % 3 and got.filter("k = 5").count() == 1
    assert got.filter("k is null").count() == 10000
    assert got.filter("k is not null").count() == 1000 + len([i for i in range(2, 30000, 3) if i >= 1000])


def test_upsert_repeated_target_key_updates_all(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "new")], "k int, v string")
    assert rows_of(upsert(t, s, ["k"]), "k", "v") == [(1, "new"), (1, "new"), (2, "c")]


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    assert rows_of(insert_if_absent(t, s, ["k"]), F.col("k").asc_nulls_last()) == [
        (1, "a"), (2, None), (None, None), (None, None)
    ]


def test_upsert_errors(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="must not be empty"):
        upsert(t, t, [])
    with pytest.raises(ValueError, match="not found"):
        upsert(t, t.select("v"), ["k"])
    with pytest.raises(ValueError, match="no columns"):
        upsert(t, t.withColumn("z", F.lit(1)), ["k"])


def test_keep_last(spark):
    s = spark.createDataFrame([(1, "x", 1), (1, None, 2), (2, "y", 5)], "k int, v string, pos int")
    assert rows_of(keep_last(s, ["k"], ["pos"]), "k") == [(1, None), (2, "y")]


def test_updates(spark):
    t = spark.createDataFrame([(1, 10), (2, None)], "id int, v int")
    assert rows_of(update_all(t, {"v": F.lit(7)}), "id") == [(1, 7), (2, 7)]
    assert rows_of(update_where(t, F.col("id") == 2, {"v": F.lit(9)}), "id") == [(1, 10), (2, 9)]
    assert rows_of(update_where(t, F.col("v") > 5, {"v": F.lit(None)}), "id") == [(1, None), (2, None)]


def test_last_write_wins(spark):
    t = spark.createDataFrame([(1, "c0", "e0"), (2, "c1", "e1"), (3, "c2", "e2")], "id int, chain string, early string")
    log = spark.createDataFrame(
        [(1, "chain", "late", 5), (1, "chain", "first", 1), (1, "early", "e", 3), (2, "early", None, 9), (9, "early", "x", 1)],
        "id int, col string, val string, at int",
    )
    got = last_write_wins(t, "id", log, "id", "col", "val", ["at"], ["chain", "early"])
    assert rows_of(got, "id") == [(1, "late", "e"), (2, "c1", None), (3, "c2", "e2")]
