"""Partitioned tables and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions.types import ColumnDef, struct_type
from bulkflow.operators import audit
from bulkflow.plans.partitions import PartitionedTable, day_partition, second_high_value
from bulkflow.plans.partitions import second_partition as second_name
from bulkflow.session import fresh_name
from workload.common import Registry, table

registry = Registry()
query = registry.query

_FIRST_DAY = "2024-01-11"
_DAY = f"CASE WHEN ts < TIMESTAMP '{_FIRST_DAY}' THEN 'P_INITIAL' ELSE strftime(ts, '%Y-%m-%d') END"


def _name(label: str) -> str:
    return fresh_name(label)[:28]


def _by_type(spark: SparkSession, sf_dir: str) -> PartitionedTable:
    """Events partitioned by a stored copy of their type."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    routed = events.withColumn("_part", F.col("event_type"))
    master = PartitionedTable(spark, _name("master")).create(routed.schema)
    master.append(routed)
    return master


def _daily(spark: SparkSession, sf_dir: str) -> PartitionedTable:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    routed = events.withColumn("_part", day_partition(F.col("ts"), _FIRST_DAY))
    daily = PartitionedTable(spark, _name("daily")).create(routed.schema)
    daily.append(routed)
    return daily


@query("SELECT event_id, value FROM events WHERE event_type = 'click'")
def partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir).partition("click").select("event_id", "value")


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return events.filter(F.col("event_type") == "error")


@query(
    """SELECT event_id, event_type, event_type AS _part FROM events WHERE event_type <> 'click'
    UNION ALL SELECT event_id, event_type, 'click' FROM events WHERE event_type = 'error'"""
)
def partition_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without validation the staging rows enter the partition whatever they are."""
    master = _by_type(spark, sf_dir)
    master.load_and_exchange(_errors(spark, sf_dir), "click", _name("staging"))
    return master.read().select("event_id", "event_type", "_part")


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def exchange_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table keeps what it got in an exchange, whatever then happens to the master."""
    master, staging = _by_type(spark, sf_dir), _name("staging")
    master.load_and_exchange(_errors(spark, sf_dir), "click", staging)
    master.drop_partition("click")
    master.append(_errors(spark, sf_dir).limit(1).withColumn("_part", F.lit("click")))
    master.create(master.read().schema)
    return spark.table(staging).select("event_id", "event_type", "value")


@query("SELECT event_id, event_type, value FROM events WHERE event_type <> 'click'")
def exchange_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the rule of the partition rejects; the exchange itself is refused."""
    master, staging = _by_type(spark, sf_dir), _name("staging")
    rule = F.col("event_type") == "click"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    try:
        master.load_and_exchange(events, "click", staging, rule=rule)
    except ValueError:
        return master.violations(staging, rule)
    raise AssertionError("the exchange should have been refused")


@query(
    """SELECT phase, side, count(*) FILTER (event_type = kind) AS row_count FROM events, (VALUES
    ('before', 'master', 'click'), ('before', 'staging', 'error'), ('after', 'master', 'error'), ('after', 'staging', 'click'))
    AS v(phase, side, kind) GROUP BY 1, 2"""
)
def exchange_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, staging = _by_type(spark, sf_dir), _name("staging")
    errors = _errors(spark, sf_dir)
    before = audit.count_pair(master.partition("click"), errors).collect()
    master.load_and_exchange(errors, "click", staging)
    after = audit.count_pair(master.partition("click"), spark.table(staging))
    counted = spark.createDataFrame(before, after.schema).withColumn("phase", F.lit("before"))
    return counted.unionByName(after.withColumn("phase", F.lit("after")))


@query(f"SELECT event_id, ts, {_DAY} AS _part FROM events")
def day_partition_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).read().select("event_id", "ts", "_part")


@query(
    """SELECT event_id, 'P_' || strftime(ts, '%Y%m%d%H%M%S') AS part_name,
    strftime(ts + INTERVAL 1 SECOND, '%Y%m%d %H:%M:%S') AS high_value FROM events"""
)
def second_partition_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", second_name(ts).alias("part_name"), second_high_value(ts).alias("high_value")
    )


@query(
    f"""SELECT partition, row_count, row_number() OVER (ORDER BY partition <> 'P_INITIAL', partition) AS position
    FROM (SELECT {_DAY} AS partition, count(*) AS row_count FROM events GROUP BY 1)"""
)
def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).listing()


@query(f"SELECT {_DAY} AS partition, count(*) AS row_count FROM events GROUP BY 1")
def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    daily.analyze()
    return daily.stats()


@query(
    """SELECT DISTINCT event_type AS partition, (SELECT count(*) FROM events) AS row_count FROM events"""
)
def cross_join_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every partition beside the count of the whole table; no rows are crossed for it."""
    return _by_type(spark, sf_dir).distribution()


@query(f"SELECT event_id, _part FROM (SELECT event_id, {_DAY} AS _part FROM events) WHERE _part = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)")
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    return daily.partition(daily.latest()).select("event_id", "_part")


@query(
    f"""SELECT event_id, _part FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'P_UNDATED' ELSE {_DAY} END AS _part FROM events)
    WHERE _part IN ('P_INITIAL', 'P_UNDATED') OR _part = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events WHERE event_type <> 'error')"""
)
def retain_latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have lost their time; they are kept and never pass for the latest day."""
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    routed = events.withColumn("_part", day_partition(F.col("ts"), _FIRST_DAY))
    daily = PartitionedTable(spark, _name("daily")).create(routed.schema)
    daily.append(routed)
    daily.retain_latest()
    return daily.read().select("event_id", "_part")


@query(f"SELECT event_id, {_DAY} AS _part FROM events WHERE ts < TIMESTAMP '{_FIRST_DAY}'")
def drop_all_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    daily.drop_all()
    return daily.read().select("event_id", "_part")


@query("SELECT event_type AS partition, count(*) FILTER (event_type <> 'view') AS row_count FROM events GROUP BY 1")
def truncate_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = _by_type(spark, sf_dir)
    master.truncate_partition("view")
    return master.listing().select("partition", "row_count")


# -- audits ------------------------------------------------------------------------------


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_count(table(spark, sf_dir, "lineitem"))


@query("SELECT count(*) AS row_count, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS max_stamp FROM orders")
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.table_stats(table(spark, sf_dir, "orders"), "o_orderdate")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.freshness(table(spark, sf_dir, "events"), "ts")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created FROM orders WHERE o_orderkey = 42")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") == 42)
    return found.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created"))


@query("SELECT count(*) AS row_count FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-09-02'")
def count_after_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_after(table(spark, sf_dir, "lineitem"), "l_shipdate", F.lit("1998-09-02").cast("timestamp_ntz"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.unique_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)"""
)
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer never appears among the users of the events."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return audit.foreign_key_violations(orders, "o_custkey", table(spark, sf_dir, "events"), "user_id")


@query(
    """SELECT 'L_ORDERKEY' AS "column", count(*) FILTER (l_orderkey IS NULL) AS null_violations, CAST(0 AS BIGINT) AS length_violations,
      CAST(0 AS BIGINT) AS precision_violations FROM lineitem
    UNION ALL SELECT 'L_EXTENDEDPRICE', 0, 0, count(*) FILTER (abs(l_extendedprice) >= 9999.995) FROM lineitem
    UNION ALL SELECT 'CELL', count(*) FILTER (l_returnflag = 'R'), count(*) FILTER (l_returnflag <> 'R' AND length(CAST(l_partkey AS VARCHAR)) > 3), 0
      FROM lineitem"""
)
def column_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("L_ORDERKEY"),
        F.col("l_extendedprice").alias("L_EXTENDEDPRICE"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("CELL"),
    )
    declared = struct_type(
        [
            ColumnDef("l_orderkey", "NUMBER", nullable=False, primary_key=True),
            ColumnDef("l_extendedprice", "NUMBER", precision=6, scale=2),
            ColumnDef("cell", "VARCHAR2", length=3, nullable=False),
        ]
    )
    return audit.column_audit(lines, declared)
