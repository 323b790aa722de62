"""CSV sources, header/body/tail files, mapped files, row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions import parse
from bulkflow.operators import rows
from bulkflow.plans import load, publish, tables
from bulkflow.session import fresh_dir, fresh_name
from bulkflow.sources import sections
from bulkflow.sources.generate import scatter
from bulkflow.sources.mapped_csv import MappedCsv, Mapping
from bulkflow.sources.position import with_row_index
from bulkflow.sources.quoted import read_quoted, store_records, stored_chunk
from bulkflow.sources.records import field_count, field_value, read_records
from bulkflow.sources.typed_csv import TypedCsv
from workload.common import Registry, lower, ragged_csv, sectioned_csv, table, text_columns, typed_csv

registry = Registry()
query = registry.query


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
)
def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    types = ["NUMBER", "NUMBER", "VARCHAR2", "NUMBER", "TIMESTAMP", "VARCHAR"]
    return lower(TypedCsv(spark, typed_csv(orders, types, "orders")).data())


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
    l_extendedprice, l_returnflag, l_linestatus, l_shipdate FROM lineitem"""
)
def typed_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    types = ["NUMBER"] * 6 + ["VARCHAR2", "CLOB", "DATE"]
    name = load.load_csv(spark, typed_csv(lines, types, "lineitem"), fresh_name("load")[:28])
    return lower(spark.table(name))


@query(
    """SELECT 'L_EXTENDEDPRICE' AS "column", count(*) AS rejected FROM lineitem WHERE l_extendedprice >= 10000
    UNION ALL SELECT 'L_QUANTITY', count(*) FROM lineitem WHERE l_quantity <> floor(l_quantity)"""
)
def typed_csv_forced_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that do not fit the type a NUMBER column is given are rejects, not NULLs."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(12,2)"), "l_quantity")
    forced = {"L_EXTENDEDPRICE": "decimal(6,2)", "L_QUANTITY": "int", "L_ORDERKEY": "bigint"}
    found = TypedCsv(spark, typed_csv(lines, ["NUMBER"] * 3, "forced"), number_types=forced).rejects()
    counts = found.groupBy("column").agg(F.count(F.lit(1)).alias("rejected"))
    names = spark.createDataFrame([("L_EXTENDEDPRICE",), ("L_QUANTITY",)], "column string")
    return names.join(counts, "column", "left").select("column", F.coalesce("rejected", F.lit(0)).alias("rejected"))


@query("SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


def _product_csv(spark: SparkSession, sf_dir: str) -> str:
    """Parts as a 20-field ';' file with the useful fields scattered; every file has a header."""
    positions = {1: "p_type", 2: "p_partkey", 4: "p_brand", 7: "p_name", 9: "p_retailprice", 11: "p_size"}
    path = fresh_dir(spark, "parts")
    wide = scatter(text_columns(table(spark, sf_dir, "part")), positions, 20, "p_partkey")
    tables.write_csv(wide, path, sep=";")
    return path


_PART = [
    Mapping("p_partkey", "product_id", parse.parse_int),
    Mapping("p_name", "product_name", parse.parse_string),
    Mapping("p_type", "category", parse.parse_nullable_string),
    Mapping("p_size", "reorder_level", parse.parse_nullable_int),
    Mapping("p_retailprice", "list_price", parse.parse_float),
]


@query(
    """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
    CAST(p_size AS BIGINT) AS reorder_level, p_retailprice AS list_price FROM part"""
)
def mapped_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MappedCsv(spark, _product_csv(spark, sf_dir), _PART, sep=";", header_count=20).data()


@query(
    """SELECT p_partkey AS product_id, 'import' AS loaded_by, TIMESTAMP '2024-01-01 07:00:00' AS updated_at,
    p_name AS product_name FROM part"""
)
def mapped_constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit("2024-01-01 07:00:00").cast("timestamp_ntz")
    maps = [
        _PART[0],
        Mapping("", "loaded_by", parse.constant(F.lit("import"))),
        Mapping("", "updated_at", parse.constant(stamp)),
        _PART[1],
    ]
    return MappedCsv(spark, _product_csv(spark, sf_dir), maps, sep=";").data()


@query(
    """SELECT p_partkey AS product_id,
    CASE WHEN regexp_full_match(p_brand, 'Brand#[0-9]') THEN CAST(substr(p_brand, 7) AS BIGINT) END AS brand_no,
    CASE WHEN NOT regexp_full_match(p_brand, 'Brand#[0-9]') THEN 'brand out of range' END AS problem FROM part"""
)
def custom_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    one_digit = lambda c: c.rlike(r"\ABrand#[0-9]\z")
    brand = parse.from_function(
        lambda c: F.when(one_digit(c), F.substring(c, 7, 10).try_cast("bigint")),
        lambda c: F.when(~one_digit(c), "brand out of range"),
    )
    maps = [_PART[0], Mapping("p_brand", "brand_no", brand)]
    out = MappedCsv(spark, _product_csv(spark, sf_dir), maps, sep=";").rows()
    return out.select("product_id", "brand_no", F.split("_error", ": ")[1].alias("problem"))


@query(
    """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS state FROM orders"""
)
def struct_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key", metadata={"db": "id"}),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderstatus").alias("STATE"),
        F.col("o_custkey").alias("unused"),
    )
    return rows.map_columns(orders, ["id", "amount", "state"])


def _event_file(spark: SparkSession, sf_dir: str) -> str:
    """Events in id order as a file with a header record and a tail record with the row count."""
    events = table(spark, sf_dir, "events")
    body = events.select("event_id", "user_id", "event_type").orderBy("event_id")
    return sectioned_csv(body, "events", ["event_id,user_id,event_type"], [f"T,{events.count()}"])


def _event_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.read_sections(spark, _event_file(spark, sf_dir), has_header=True, has_tail=True)


_POSITIONS = "SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) AS rn FROM events"


@query(
    f"""SELECT CAST(0 AS BIGINT) AS row_index, 'header' AS role, CAST(NULL AS BIGINT) AS body_index,
    'event_id' AS first, 'event_type' AS third
    UNION ALL SELECT rn, 'body', rn - 1, CAST(event_id AS VARCHAR), event_type FROM ({_POSITIONS})
    UNION ALL SELECT count(*) + 1, 'tail', NULL, 'T', '' FROM events"""
)
def csv_header_body_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _event_sections(spark, sf_dir)
    return s.select(
        "row_index", "role", "body_index", field_value(F.col("fields"), 0).alias("first"),
        field_value(F.col("fields"), 2).alias("third"),
    )


@query("SELECT count(*) AS body_rows FROM events")
def csv_body_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.body_count(spark, _event_file(spark, sf_dir), has_header=True, has_tail=True)


@query(
    """SELECT 'header count' AS "check", '3' AS expected, '3' AS actual, true AS ok
    UNION ALL SELECT 'header[0]', 'event_id', 'event_id', true
    UNION ALL SELECT 'header[2]', 'kind', 'event_type', false
    UNION ALL SELECT 'tail count', '2', '2', true
    UNION ALL SELECT 'tail[1]', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), true FROM events
    UNION ALL SELECT 'tail[5]', 'x', NULL, false
    UNION ALL SELECT 'body rows', '> 0', CAST(count(*) AS VARCHAR), true FROM events"""
)
def csv_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").count()
    return sections.validation_report(
        _event_sections(spark, sf_dir),
        header={0: "event_id", 2: "kind"},
        header_count=3,
        tail={1: str(n), 5: "x"},
        tail_count=2,
        body_not_empty=True,
    )


@query(
    """SELECT page_id, CAST(len(string_split(url, '/')) AS BIGINT) AS n_fields, string_split(url, '/')[3] AS host,
    coalesce(string_split(url, '/')[5], '') AS fifth FROM pages"""
)
def csv_line_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of each page's address as a CSV record of its own length."""
    fields = F.col("fields")
    return read_records(spark, ragged_csv(spark, sf_dir)).select(
        field_value(fields, 0).cast("bigint").alias("page_id"), (field_count(fields) - 1).cast("bigint").alias("n_fields"),
        field_value(fields, 3).alias("host"), field_value(fields, 5).alias("fifth"),
    )


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = table(spark, sf_dir, "events").select("event_id", "user_id").orderBy("event_id")
    path = sectioned_csv(body, "events", [])
    return with_row_index(read_records(spark, path), "row_index")


@query(f"SELECT rn - 1 AS row_index, event_id FROM ({_POSITIONS})")
def row_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_events(spark, sf_dir).select("row_index", field_value(F.col("fields"), 0).cast("bigint").alias("event_id"))


@query(
    f"""SELECT (rn - 1) // 700 AS chunk_id, count(*) AS chunk_rows, min(event_id) AS first_id,
    (rn - 1) // 700 = ((SELECT count(*) FROM events) - 1) // 700 AS ended FROM ({_POSITIONS}) GROUP BY 1"""
)
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = sections.assign_chunks(_event_sections(spark, sf_dir), 700)
    first = F.min(field_value(F.col("fields"), 0).cast("bigint"))
    return chunks.groupBy("chunk_id", "ended").agg(F.count(F.lit(1)).alias("chunk_rows"), first.alias("first_id"))


@query(f"SELECT (rn - 1) // 1000 + 1 AS batch_no, count(*) AS rows FROM ({_POSITIONS}) GROUP BY 1")
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.batch_plan(_numbered_events(spark, sf_dir), "row_index", 1000)


@query(
    """SELECT ts, CAST(user_id AS INTEGER) AS worker, event_type AS value, event_type <> 'view' AS changed
    FROM events WHERE event_type <> 'error'"""
)
def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "monitor")
    log = table(spark, sf_dir, "events").filter("event_type <> 'error'").select(
        F.col("ts").cast("string").alias("ts"), F.col("user_id").alias("worker"), F.col("event_type").alias("value"),
        (F.col("event_type") != "view").alias("changed"),
    )
    tables.write_csv(log, path)
    schema = "ts string, worker int, value string, changed boolean"
    return spark.read.option("header", True).schema(schema).csv(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _texts_with_breaks(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a CSV file whose texts hold line breaks, quotes and commas."""
    path = fresh_dir(spark, "texts")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), F.replace("text", F.lit("\r"), F.lit(" ")).alias("text"), "lang")
    docs.write.options(escape='"', quoteAll=True).csv(path)
    return path


@query("SELECT doc_id, md5(replace(text, chr(13), ' ')) AS digest, lang FROM documents")
def quoted_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that go over many lines, read by splits."""
    fields = F.col("fields")
    return read_quoted(spark, _texts_with_breaks(spark, sf_dir)).select(
        field_value(fields, 0).cast("bigint").alias("doc_id"), F.md5(field_value(fields, 1)).alias("digest"), field_value(fields, 2).alias("lang")
    )


@query(f"SELECT rn - 1 AS row_index, event_id FROM ({_POSITIONS}) WHERE (rn - 1) // 300 = 2")
def stored_chunk_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third chunk of a stored file, without the rest of it."""
    path = fresh_dir(spark, "stored")
    store_records(_numbered_events(spark, sf_dir), path)
    return stored_chunk(spark, path, 2, 300).select("row_index", field_value(F.col("fields"), 0).cast("bigint").alias("event_id"))
