"""Versioned tables: merges that leave files alone, racing writers, retention, keys, digests, vacuum."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.plans import ledger, load, tables
from bulkflow.plans.partitions import PartitionedTable, day_partition
from bulkflow.plans.publish import ABTable, Snapshot
from bulkflow.plans.versions import Reference, VersionedTable, content_digest
from bulkflow.session import fresh_name, fresh_table_dir
from workload.common import Registry, table, typed_csv

registry = Registry()
query = registry.query


def _table(spark: SparkSession, label: str, schema, **settings) -> VersionedTable:
    return VersionedTable(spark, fresh_table_dir(spark, label), **settings).create(schema)


# -- merges that rewrite only what they touch ----------------------------------------------

_NEAR = "l_orderkey <= (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 100 FROM orders)"
_LAST = f"""(SELECT l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE {_NEAR}) WHERE rn = 1)"""
_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, VersionedTable]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    kept = orders.filter("o_orderstatus <> 'P'")
    rows = max(1, kept.count() // 100)
    stored = _table(spark, "orders", orders.schema, keys=["o_orderkey"], rows_per_file=rows)
    stored.append(kept)
    return orders, stored


def _feed(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """The lines of the first hundredth of the order keys, each a change of its order's price."""
    bounds = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    limit = bounds.select((F.col("low") + F.floor((F.col("high") - F.col("low")) / 100)).cast("bigint")).scalar()
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") <= limit)
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"), *_ORDER)


@query(
    f"""WITH o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey, o_orderstatus, coalesce(s.l_extendedprice, o_totalprice) AS o_totalprice FROM o LEFT JOIN {_LAST} s ON o_orderkey = l_orderkey
    UNION ALL SELECT l_orderkey, NULL, l_extendedprice FROM {_LAST} s WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey)"""
)
def merge_copy_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that concerns a hundredth of the keys."""
    orders, stored = _orders(spark, sf_dir)
    stored.merge(_feed(spark, sf_dir, orders), _ORDER)
    return stored.read()


@query("SELECT true AS others_kept, true AS few_rewritten, true AS matched_rewritten")
def merge_untouched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the merge above rewrote the files with a matched key, only those, and few."""
    orders, stored = _orders(spark, sf_dir)
    feed = _feed(spark, sf_dir, orders)
    before = stored.version()
    concerned = stored.read().select("o_orderkey", F.col("_metadata.file_path").alias("path")).join(feed.select("o_orderkey"), "o_orderkey", "left_semi")
    concerned = concerned.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("file"), F.lit(True).alias("hit")).distinct()
    after = stored.files(stored.merge(feed, _ORDER)).select("file", F.lit(True).alias("stayed"))
    seen = stored.files(before).select("file").join(concerned, "file", "left").join(after, "file", "left")
    hit, stayed = F.coalesce("hit", F.lit(False)), F.coalesce("stayed", F.lit(False))
    return seen.agg(
        F.bool_and(hit | stayed).alias("others_kept"),
        (F.count(F.when(~stayed, 1)) <= 5 + F.count(F.lit(1)) * 0.05).alias("few_rewritten"),
        F.bool_and(~hit | ~stayed).alias("matched_rewritten"),
    )


@query(
    """WITH s AS (SELECT o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT c_custkey AS "C_CUSTKEY", coalesce(s.o_totalprice, c_acctbal) AS "C_ACCTBAL", c_mktsegment AS "C_MKTSEGMENT" FROM customer LEFT JOIN s ON c_custkey = o_custkey
    UNION ALL SELECT o_custkey, o_totalprice, NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"""
)
def upsert_csv_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed CSV file merged into a versioned table: the last row of the file wins."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_acctbal").alias("C_ACCTBAL"), F.col("c_mktsegment").alias("C_MKTSEGMENT")
    )
    stored = _table(spark, "customers", customers.schema, keys=["C_CUSTKEY"])
    stored.append(customers)
    feed = table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal")
    )
    load.upsert_csv(spark, typed_csv(feed, ["NUMBER", "NUMBER"], "feed"), stored, ["c_custkey"])
    return stored.read()


# -- racing writers, and partitions that change in one version ------------------------------


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def racing_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers append a part of the lines each at the same time; none of them is lost."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    stored = _table(spark, "lines", lines.schema)
    with ThreadPoolExecutor(4) as writers:
        list(writers.map(lambda n: stored.append(lines.filter(F.pmod("l_orderkey", F.lit(4)) == n)), range(4)))
    return stored.read()


def _daily(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, VersionedTable]:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    routed = events.withColumn("day", day_partition(F.col("ts"), "2024-01-11"))
    stored = _table(spark, label, routed.schema, keys=["event_id"], partition="day")
    stored.append(routed)
    return routed, stored


_DAYS = """(SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN ts END AS ts, CASE WHEN event_type = 'error' THEN 'P_UNDATED'
    WHEN ts < TIMESTAMP '2024-01-11' THEN 'P_INITIAL' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events)"""


@query(
    f"""SELECT event_id, event_type, ts, day, 1 AS versions FROM {_DAYS} WHERE day IN ('P_UNDATED', 'P_INITIAL')
    OR day = (SELECT max(day) FROM {_DAYS} WHERE day NOT LIKE 'P%')"""
)
def atomic_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All older days go in one version, whatever their number."""
    _, stored = _daily(spark, sf_dir, "daily")
    before = stored.version()
    after = stored.retain_latest()
    return stored.read().withColumn("versions", F.lit(after - before))


@query(f"SELECT event_id, event_type, ts, day FROM {_DAYS}")
def reader_of_an_old_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that began before a truncate, a new load and a vacuum still gets its rows."""
    routed, stored = _daily(spark, sf_dir, "daily")
    reader = stored.read()
    stored.truncate()
    stored.append(routed.limit(10))
    stored.vacuum(keep=3, grace_seconds=0)
    return reader


@query(
    f"""SELECT day AS partition, CAST(count(*) AS BIGINT) AS row_count, min(event_id) AS low, max(event_id) AS high FROM (
    SELECT event_id, day FROM {_DAYS} WHERE day <> 'P_INITIAL' AND day <> '2024-01-15' UNION ALL
    SELECT event_id, '2024-01-15' FROM {_DAYS} WHERE day = 'P_INITIAL' UNION ALL SELECT -event_id, '2024-01-12' FROM {_DAYS} WHERE day = '2024-01-12') GROUP BY 1"""
)
def partition_stats_by_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and bounds after an append, an exchange and a drop, without reading a row."""
    routed, stored = _daily(spark, sf_dir, "daily")
    stored.append(routed.filter("day = '2024-01-12'").withColumn("event_id", -F.col("event_id")))
    other = _table(spark, "staging", routed.drop("day").schema, keys=["event_id"])
    other.append(routed.filter("day = 'P_INITIAL'").drop("day"))
    stored.exchange("2024-01-15", other)
    stored.drop_partitions(["P_INITIAL"])
    return stored.partitions().select("partition", "row_count", "low", "high")


# -- comparing content ---------------------------------------------------------------------


@query("SELECT count(*) AS row_count, true AS same, true AS change_found FROM lineitem")
def digest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published version has the base's content by its manifest; one changed cell is found, count and maximum being equal."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    stored = _table(spark, "lines", lines.schema)
    half = F.pmod("l_orderkey", F.lit(2)) == 0
    stored.append(lines.filter(half))
    stored.append(lines.filter(~half))
    first = F.struct("l_orderkey", "l_linenumber")
    one = lines.agg(F.min(first).alias("at"))
    changed = lines.withColumn("l_quantity", F.when(first == one.scalar(), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return stored.digest().select(
        "row_count",
        (F.col("digest") == lines.agg(content_digest(lines)).scalar()).alias("same"),
        (F.col("digest") != changed.agg(content_digest(changed)).scalar()).alias("change_found"),
    )


# -- keys ----------------------------------------------------------------------------------


def _refused(write, why: str) -> bool:
    try:
        write()
    except Exception as e:
        if why not in str(e):
            raise
        return True
    return False


@query("SELECT count(*) AS row_count, true AS twice_refused, true AS known_refused, true AS orphan_refused FROM orders")
def key_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with unique keys and known customers: batches that break a rule are refused as a whole."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer")
    stored = _table(
        spark, "orders", orders.schema, keys=["o_orderkey"], unique=True, references=[Reference("o_custkey", lambda: customers, "c_custkey")]
    )
    odd = F.pmod("o_orderkey", F.lit(2)) == 1
    stored.append(orders.filter(odd))
    fresh = orders.filter(~odd)
    refused = [
        _refused(lambda: stored.append(fresh.union(fresh.limit(1))), "more than once"),
        _refused(lambda: stored.append(orders), "already"),
        _refused(lambda: stored.append(fresh.withColumn("o_custkey", -F.col("o_custkey"))), "no parent"),
    ]
    stored.append(fresh)
    names = ("twice_refused", "known_refused", "orphan_refused")
    return stored.read().agg(F.count(F.lit(1)).alias("row_count")).select("row_count", *(F.lit(x).alias(n) for n, x in zip(names, refused)))


# -- folders -------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus, true AS swept, true AS owned_kept FROM orders")
def vacuum_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncates, swaps and a failed load leave folders without owner; they go, all others stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    plain, pair, shown = fresh_name("vacuum")[:28], ABTable(spark, fresh_name("ab")[:26]), Snapshot(spark, fresh_name("shown"))
    tables.create_or_replace(spark, plain, orders.schema)
    tables.append(orders, plain)
    left = [tables.location(spark, plain)]
    tables.truncate(spark, plain)
    tables.append(orders, plain)
    pair.swap(orders)
    pair.swap(orders)
    left.append(tables.location(spark, pair.inactive()))
    pair.swap(orders, drop_old=True)
    left.append(tables.write_fresh(orders, "failed")[0])
    shown.publish(orders)
    daily = PartitionedTable(spark, fresh_name("parts")[:28]).create(orders.withColumn("_part", F.lit("")).schema)
    daily.append(orders.withColumn("_part", F.col("o_orderstatus")))
    left.append(tables.location(spark, daily.name))
    tables.truncate(spark, daily.name)
    daily.append(orders.withColumn("_part", F.col("o_orderstatus")))
    used = [tables.location(spark, plain), tables.location(spark, pair.active()), shown.path(), tables.location(spark, daily.name)]
    gone = ledger.vacuum(spark, grace_seconds=0)
    swept = all(any(f"/{g}" in path for g in gone) for path in left)
    kept = not any(f"/{g}" in path for g in gone for path in used)
    same = [spark.table(n).count() for n in (plain, pair.name, shown.name, daily.name)]
    return daily.read().select("o_orderkey", "o_orderstatus", F.lit(swept).alias("swept"), F.lit(kept and len(set(same)) == 1).alias("owned_kept"))
