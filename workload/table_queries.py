"""Table writes, merges, updates and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions import parse
from bulkflow.functions.types import ColumnDef, primary_key
from bulkflow.operators import audit, merge
from bulkflow.plans import load, tables
from bulkflow.plans.partitions import PartitionedTable, day_partition
from bulkflow.plans.publish import ABTable, Snapshot
from bulkflow.plans.publish import full_reload as reload
from bulkflow.session import fresh_dir, fresh_name
from bulkflow.sources import generate
from bulkflow.sources.mapped_csv import MappedCsv, Mapping
from workload.common import Registry, lower, table, text_columns, typed_csv

registry = Registry()
query = registry.query


def _name(label: str) -> str:
    return fresh_name(label)[:28]


# -- merges ------------------------------------------------------------------------------

_LAST_LINE = """(SELECT l_orderkey AS o_orderkey, l_extendedprice AS o_totalprice FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
    WHERE rn = 1)"""
_CLOSED = "(SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'O')"
_LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a change of its order's price, many lines per order."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"), *_LINE_ORDER)


def _closed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "O")
    return orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    f"""SELECT t.o_orderkey, t.o_orderstatus, CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END
    AS o_totalprice, t.o_orderpriority FROM {_CLOSED} t LEFT JOIN {_LAST_LINE} s ON t.o_orderkey = s.o_orderkey
    UNION ALL SELECT o_orderkey, NULL, o_totalprice, NULL FROM {_LAST_LINE} s
    WHERE NOT EXISTS (SELECT 1 FROM {_CLOSED} t WHERE t.o_orderkey = s.o_orderkey)"""
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert(_closed_orders(spark, sf_dir), _line_feed(spark, sf_dir), ["o_orderkey"], _LINE_ORDER)


_LAST_EVENT = """(SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"""


@query(
    f"""SELECT c_custkey, c_name, CASE WHEN e.user_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal,
    CASE WHEN e.user_id IS NULL THEN c_mktsegment ELSE event_type END AS c_mktsegment
    FROM customer LEFT JOIN {_LAST_EVENT} e ON c_custkey = user_id
    UNION ALL SELECT user_id, NULL, value, event_type FROM {_LAST_EVENT} e
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)"""
)
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    feed = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"), F.col("event_type").alias("c_mktsegment"),
        "ts", "event_id",
    )
    return merge.upsert(target, feed, ["c_custkey"], ["ts", "event_id"])


@query(
    """WITH s AS (SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
      AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1)
    SELECT c_custkey, c_name, CASE WHEN s.user_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal
    FROM customer LEFT JOIN s ON c_custkey = s.user_id
    UNION ALL SELECT user_id, NULL, value FROM s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)
    UNION ALL SELECT NULL, NULL, value FROM events WHERE event_type = 'error'"""
)
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    feed = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("c_custkey"), F.col("value").alias("c_acctbal"),
        "ts", "event_id",
    )
    return merge.upsert(target, feed, ["c_custkey"], ["ts", "event_id"])


@query(
    """SELECT doc_id, quality, toxic FROM labels
    UNION ALL SELECT doc_id, NULL, NULL FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_if_absent(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), ["doc_id"])


@query(
    """WITH s AS (SELECT doc_id AS conv_id, CAST(quality AS BIGINT) AS turn, 'label' || toxic AS role FROM labels)
    SELECT c.conv_id, c.turn, CASE WHEN s.conv_id IS NULL THEN c.role ELSE s.role END AS role, c.text
    FROM conversations c LEFT JOIN s ON c.conv_id = s.conv_id AND c.turn = s.turn
    UNION ALL SELECT conv_id, turn, role, NULL FROM s
    WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = s.conv_id AND c.turn = s.turn)"""
)
def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("conv_id"), F.col("quality").cast("bigint").alias("turn"),
        F.concat(F.lit("label"), F.col("toxic")).alias("role"),
    )
    return merge.upsert(table(spark, sf_dir, "conversations"), feed, ["conv_id", "turn"])


@query(
    """WITH s AS (SELECT o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT c_custkey, CASE WHEN s.o_custkey IS NULL THEN c_acctbal ELSE o_totalprice END AS c_acctbal, c_mktsegment
    FROM customer LEFT JOIN s ON c_custkey = o_custkey
    UNION ALL SELECT o_custkey, o_totalprice, NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"""
)
def upsert_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a typed CSV file merged into the customers: the last row of the file wins."""
    target = Snapshot(spark, _name("customers"))
    target.publish(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"))
    feed = table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal")
    )
    load.upsert_csv(spark, typed_csv(feed, ["NUMBER", "NUMBER"], "feed"), target, ["c_custkey"])
    return target.read()


# -- updates -----------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_orderstatus, TIMESTAMP '2000-01-01 00:00:00' AS o_orderdate FROM orders"""
)
def update_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return merge.update_all(orders, {"o_orderdate": F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")})


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders"""
)
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return merge.update_where(orders, F.col("o_orderkey") == 7, {"o_orderstatus": F.lit("X")})


_WRITES = """(SELECT * FROM (SELECT l_orderkey, l_returnflag, l_linestatus, l_extendedprice, row_number() OVER (
    PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
    l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1)"""


@query(
    f"""SELECT o.o_orderkey, CASE WHEN a.l_orderkey IS NULL THEN o_totalprice ELSE a.l_extendedprice END AS o_totalprice,
    CASE WHEN r.l_orderkey IS NULL THEN o_orderpriority ELSE CAST(r.l_extendedprice AS VARCHAR) END AS o_orderpriority,
    o_orderstatus FROM orders o LEFT JOIN {_WRITES} a ON a.l_orderkey = o.o_orderkey AND a.l_returnflag = 'A'
    LEFT JOIN {_WRITES} r ON r.l_orderkey = o.o_orderkey AND r.l_returnflag = 'R'"""
)
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    log = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "A", "o_totalprice").when(F.col("l_returnflag") == "R", "o_orderpriority").alias("column"),
        F.col("l_extendedprice").cast("string").alias("value"),
        *_LINE_ORDER,
    )
    return merge.last_write_wins(
        orders, "o_orderkey", log, "l_orderkey", "column", "value", _LINE_ORDER, ["o_totalprice", "o_orderpriority"]
    )


# -- writes and publishing ---------------------------------------------------------------


@query(
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(100 AS BIGINT) AS name_length, 'C_CUSTKEY' AS "key"
    FROM customer"""
)
def create_or_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bare NUMBER keeps fractions; rows that break the declaration are refused as a whole."""
    name = _name("customer")
    tables.create_or_replace(spark, name, [ColumnDef("old", "CLOB")])
    tables.create_or_replace(
        spark,
        name,
        [
            ColumnDef("c_custkey", "NUMBER", nullable=False, primary_key=True),
            ColumnDef("c_name", "VARCHAR2", length=100),
            ColumnDef("c_acctbal", "NUMBER"),
            ColumnDef("c_mktsegment", "VARCHAR"),
        ],
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    tables.append(customers, name)
    other_keys = customers.withColumn("c_custkey", -1 - F.col("c_custkey"))
    for broken, why in (
        (customers.withColumn("c_custkey", F.lit(None).cast("bigint")), "must not be null"),
        (other_keys.withColumn("c_name", F.repeat("c_name", 20)), "at most 100"),
        (other_keys.union(customers.limit(1)), "is in the table already"),
        (other_keys.union(other_keys.limit(1)), "occurs more than once"),
    ):
        try:
            tables.append(broken, name)
        except Exception as e:
            if why not in str(e):
                raise
        else:
            raise AssertionError("the append should have been refused")
    kept = tables.declared(spark, name)
    return lower(spark.table(name)).select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"), "c_mktsegment",
        F.lit(kept["C_NAME"].metadata["length"]).cast("bigint").alias("name_length"), F.lit(primary_key(kept)[0]).alias("key"),
    )


@query(
    """SELECT o_orderkey AS id, o_totalprice AS amount FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem"""
)
def batched_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("append")
    first = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    tables.create_or_replace(spark, name, first.schema)
    tables.append(first, name)
    second = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ID"), F.col("l_extendedprice").alias("amount"))
    tables.append(second, name)
    return spark.table(name)


@query(
    """SELECT count(*) AS before, count(*) FILTER (WHERE false) AS after,
    (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS again FROM orders"""
)
def truncate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table is emptied; rows appended to one of its partitions afterwards are alone there."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("_part"))
    parted = PartitionedTable(spark, _name("truncate")).create(orders.schema)
    parted.append(orders)
    before = audit.row_count(parted.read()).first()[0]
    tables.truncate(spark, parted.name)
    after = audit.row_count(parted.read()).first()[0]
    parted.append(orders.filter("_part = 'O' AND o_orderkey % 2 = 0"))
    counts = (F.lit(n).cast("bigint").alias(c) for n, c in ((before, "before"), (after, "after")))
    return audit.row_count(parted.read()).select(*counts, F.col("row_count").alias("again"))


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapped CSV file replaces a table, and the snapshot published from it is refreshed."""
    base, published = Snapshot(spark, _name("base")), Snapshot(spark, _name("mv"), columns=["id", "price"])
    path = fresh_dir(spark, "orders")
    tables.write_csv(text_columns(table(spark, sf_dir, "orders")), path)
    maps = [
        Mapping("o_orderkey", "id", parse.parse_int),
        Mapping("o_orderstatus", "status"),
        Mapping("o_totalprice", "price", parse.parse_float),
    ]
    reload(MappedCsv(spark, path, maps), base, ["id", "status", "price"], published)
    return published.read()


class _Orders:
    """A source of orders; rows of one status carry an error."""

    def __init__(self, orders: DataFrame, bad_status: str | None = None) -> None:
        self.orders, self.bad_status = orders, bad_status

    def validate(self) -> None:
        pass

    def rows(self) -> DataFrame:
        error = F.when(F.col("o_orderstatus") == self.bad_status, "bad status") if self.bad_status else F.lit(None)
        return self.orders.withColumn("_error", error.cast("string"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def reload_failure_keeps_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reload that meets a bad row fails and leaves table and published name as they were."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    base, published = Snapshot(spark, _name("base")), Snapshot(spark, _name("mv"))
    reload(_Orders(orders), base, orders.columns, published)
    try:
        reload(_Orders(orders.withColumn("o_orderkey", -F.col("o_orderkey")), "F"), base, orders.columns, published)
    except Exception as e:
        if "bad status" not in str(e):
            raise
        return published.read()
    raise AssertionError("the reload should have failed")


@query("SELECT count(*) AS rows, true AS adds_up FROM orders")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a reload as one row, and whether its times add up to the total."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    report = reload(_Orders(orders), Snapshot(spark, _name("base")), orders.columns, Snapshot(spark, _name("mv"))).to_df(spark)
    parts = F.col("insert_seconds") + F.col("commit_seconds") + F.col("refresh_seconds")
    return report.select("rows", (F.abs(parts - F.col("total_seconds")) < 1e-6).alias("adds_up"))


@query("SELECT o_orderkey FROM orders")
def published_snapshot_outlives_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published name still shows its rows after its base has moved on by two versions."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    base, published = Snapshot(spark, _name("base")), Snapshot(spark, _name("mv"), columns=["o_orderkey"])
    reload(_Orders(orders), base, ["o_orderkey"], published)
    for n in (1, 2, 3):
        base.publish(orders.withColumn("o_orderkey", F.col("o_orderkey") * -n))
    return published.read()


@query("SELECT o_orderkey FROM orders")
def ab_swap_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that began before two swaps still gets the rows that it began with."""
    pair = ABTable(spark, _name("ab")[:26])
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    pair.swap(orders)
    reader = spark.table(pair.name)
    reader.count()
    for n in (1, 2):
        pair.swap(orders.withColumn("o_orderkey", F.col("o_orderkey") * -n))
    return reader


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def complete_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = Snapshot(spark, _name("snapshot"), columns=["o_orderkey", "o_totalprice"])
    orders = table(spark, sf_dir, "orders")
    snapshot.publish(orders)
    snapshot.publish(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return snapshot.read()


@query("SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority FROM orders")
def ab_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = ABTable(spark, _name("ab")[:26])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    pair.swap(orders)
    pair.swap(orders.withColumn("o_orderpriority", F.lower("o_orderpriority")), drop_old=True)
    return spark.table(pair.name)


@query(
    """SELECT count(*) AS base_count, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS base_latest,
    count(*) AS published_count, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS published_latest, true AS consistent
    FROM lineitem"""
)
def publish_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "lineitem")
    snapshot = Snapshot(spark, _name("lines"), columns=["l_orderkey", "l_shipdate"])
    snapshot.publish(base)
    return audit.publish_check(base, snapshot.read(), "l_shipdate")


@query(
    """SELECT event_id, event_type, TIMESTAMP '2024-03-01 12:00:00' AS ts, '2024-03-01' AS _part FROM events
    UNION ALL SELECT event_id, event_type, ts, 'P_INITIAL' FROM events WHERE ts < TIMESTAMP '2024-01-11' AND event_type <> 'error'
    UNION ALL SELECT event_id, event_type, NULL, 'P_UNDATED' FROM events WHERE event_type = 'error'"""
)
def rolling_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events by day, errors without a time, then one new day: the older days go, the rest stays."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    undated = events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    routed = undated.withColumn("_part", day_partition(F.col("ts"), "2024-01-11"))
    daily = PartitionedTable(spark, _name("rolling")).create(routed.schema)
    daily.append(routed)
    new = events.withColumn("ts", F.lit("2024-03-01 12:00:00").cast("timestamp_ntz"))
    daily.rolling_replace(new.withColumn("_part", day_partition(F.col("ts"), "2024-01-11")))
    return daily.read()


# -- generated batches, as many rows as a table has --------------------------------------


@query(
    """SELECT i AS "ID", 'VAL_' || i AS "DATA_VALUE", 'Generated row #' || i AS "DESCRIPTION",
    CASE WHEN i % 10 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS "STATUS", latest AS "CREATED_AT"
    FROM (SELECT o_orderkey AS i FROM orders), (SELECT max(o_orderdate) AS latest FROM orders)"""
)
def generate_bulk_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every order's key."""
    orders = table(spark, sf_dir, "orders")
    return generate.bulk_data_for(orders.select(F.col("o_orderkey").alias("id")), orders.agg(F.max("o_orderdate")).scalar())


def _digits(start: int, length: int) -> str:
    return f"CAST('0x' || substr(md5('42-' || i), {start}, {length}) AS BIGINT)"


_CENTS = f"(1000 + {_digits(9, 6)} % 10000)"
_PRICE_CENTS = f"(({_CENTS} * 3 + 1) // 2)"


@query(
    f"""SELECT CAST(i AS VARCHAR) AS "ID", 'PROD-' || lpad(CAST(i AS VARCHAR), 8, '0') AS "CODE", 'Product Name ' || i AS "NAME",
    CASE WHEN {_digits(1, 4)} % 100 < 20 THEN '' ELSE 'Description for product ' || i || ' with some details.' END AS "DESCRIPTION",
    ['Electronics', 'Clothing', 'Home', 'Garden', 'Toys', 'Books', 'Tools'][{_digits(5, 4)} % 7 + 1] AS "CATEGORY",
    ({_CENTS} // 100) || '.' || lpad(CAST({_CENTS} % 100 AS VARCHAR), 2, '0') AS "COST",
    ({_PRICE_CENTS} // 100) || '.' || lpad(CAST({_PRICE_CENTS} % 100 AS VARCHAR), 2, '0') AS "PRICE",
    CASE WHEN {_digits(15, 4)} % 100 < 10 THEN '' ELSE CAST({_digits(19, 4)} % 50 AS VARCHAR) END AS "REORDER_LEVEL",
    CASE WHEN {_digits(23, 4)} % 100 < 10 THEN '' ELSE CAST(50 + {_digits(27, 4)} % 100 AS VARCHAR) END AS "TARGET_LEVEL",
    CASE WHEN {_digits(31, 2)} % 100 < 5 THEN '1' ELSE '0' END AS "DISCONTINUED"
    FROM (SELECT p_partkey + (SELECT max(p_partkey) FROM part) AS i FROM part)"""
)
def generate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new product for every part, with keys that go on after the last part."""
    part = table(spark, sf_dir, "part")
    last = part.agg(F.max("p_partkey")).scalar()
    return generate.products_for(part.select((F.col("p_partkey") + last).alias("id")))


@query(
    """SELECT l_orderkey, l_linenumber, TIMESTAMP '2000-01-01 00:00:00' AS updated_at FROM lineitem"""
)
def generate_constant_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line's key with one and the same stamp."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return generate.constant_batch(keys, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))


@query(
    """SELECT m + i AS "ID", 'PID-' || (m + i) AS "PID", 'DATA_' || i AS "DATA_VALUE", 'Record ' || i || ' of ' || n AS "DESCRIPTION",
    'ACTIVE' AS "STATUS", TIMESTAMP '2024-01-05 10:00:00' AS "COMMITTED_AT"
    FROM (SELECT c_custkey AS i FROM customer), (SELECT max(o_orderkey) AS m FROM orders), (SELECT count(*) AS n FROM customer)"""
)
def append_next_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every customer's key, with ids that go on after the last order."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    stamp = F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
    return generate.next_ids_for(customers, table(spark, sf_dir, "orders"), "o_orderkey", stamp)
