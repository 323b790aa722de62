"""Row shape, strict conversion, identifiers and times."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions import names, parse, times
from bulkflow.operators import rows
from bulkflow.sources.records import read_records
from workload.common import Registry, ragged_csv, table

registry = Registry()
query = registry.query


@query(
    """SELECT * FROM (SELECT doc_id, nullif(trim(CASE WHEN lang = 'es' THEN '   ' ELSE ' ' || lang || ' ' END), '') AS lang,
    nullif(trim(CASE WHEN source IN ('src1', 'src5') THEN '' ELSE source || '  ' END), '') AS source FROM documents)
    WHERE coalesce(lang, source) IS NOT NULL"""
)
def trim_skip_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "es", "   ").otherwise(F.concat(F.lit(" "), "lang", F.lit(" "))).alias("lang"),
        F.when(F.col("source").isin("src1", "src5"), "").otherwise(F.concat("source", F.lit("  "))).alias("source"),
    )
    return rows.trim_skip_blank(padded, ["lang", "source"])


@query(
    """SELECT page_id, nullif(string_split(url, '/')[1], '') AS scheme, nullif(string_split(url, '/')[2], '') AS gap,
    nullif(string_split(url, '/')[3], '') AS host, nullif(string_split(url, '/')[4], '') AS section,
    nullif(string_split(url, '/')[5], '') AS page FROM pages"""
)
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of any length, read from a file."""
    records = read_records(spark, ragged_csv(spark, sf_dir))
    found = records.select(*rows.align(F.col("fields"), ["page_id", "scheme", "gap", "host", "section", "page"]))
    return found.withColumn("page_id", F.col("page_id").cast("bigint"))


@query(
    """SELECT page_id, CASE WHEN len(string_split(url, '/')) <> 5
    THEN 'expected 5 values, got ' || len(string_split(url, '/')) END AS problem FROM pages"""
)
def strict_field_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.col("fields")
    parts = F.slice(fields, F.lit(2), F.size(fields))  # what stands behind the id
    return read_records(spark, ragged_csv(spark, sf_dir)).select(F.get(fields, F.lit(0)).cast("bigint").alias("page_id"), rows.width_error(parts, 5).alias("problem"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cells of all kinds: integers, decimals, words, empty ones."""
    text = (
        F.when(F.col("l_returnflag") == "A", F.col("l_orderkey").cast("string"))
        .when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string"))
        .when(F.col("l_linestatus") == "O", "")
        .otherwise(F.concat("l_linestatus", F.col("l_partkey").cast("string")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("cell"))


_CELLS = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN CAST(l_orderkey AS VARCHAR)
    WHEN l_returnflag = 'R' THEN CAST(l_quantity AS VARCHAR) WHEN l_linestatus = 'O' THEN ''
    ELSE l_linestatus || CAST(l_partkey AS VARCHAR) END AS cell FROM lineitem)"""
_INT = "CASE WHEN regexp_full_match(cell, '[+-]?[0-9]+') THEN TRY_CAST(cell AS BIGINT) END"
_FLOAT = "CASE WHEN regexp_full_match(cell, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(cell AS DOUBLE) END"
_KEYS = "l_orderkey, l_linenumber, l_partkey, cell"


def _parsed(spark: SparkSession, sf_dir: str, parser: parse.Parser) -> DataFrame:
    p = parser(F.col("cell"))
    return _cells(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cell", p.value.alias("value"), p.error.alias("problem")
    )


@query(
    f"""SELECT {_KEYS}, {_INT} AS value, CASE WHEN {_INT} IS NULL THEN 'invalid integer ''' || cell || '''' END AS problem
    FROM {_CELLS}"""
)
def parse_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, parse.parse_int)


@query(
    f"""SELECT {_KEYS}, {_FLOAT} AS value, CASE WHEN {_FLOAT} IS NULL THEN 'invalid float ''' || cell || '''' END AS problem
    FROM {_CELLS}"""
)
def parse_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, parse.parse_float)


@query(
    f"""SELECT {_KEYS}, nullif(cell, '') AS text_value, {_INT} AS int_value,
    CASE WHEN cell <> '' AND {_INT} IS NULL THEN 'invalid integer ''' || cell || '''' END AS problem FROM {_CELLS}"""
)
def parse_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, number = parse.parse_nullable_string(F.col("cell")), parse.parse_nullable_int(F.col("cell"))
    return _cells(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cell", text.value.alias("text_value"),
        number.value.alias("int_value"), number.error.alias("problem"),
    )


@query(
    f"""SELECT {_KEYS}, {_FLOAT} AS value, {_INT} IS NOT NULL AS is_integer,
    CASE WHEN cell <> '' AND {_FLOAT} IS NULL THEN 'invalid NUMBER ''' || cell || '''' END AS problem FROM {_CELLS}"""
)
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse.parse_number(F.col("cell"))
    return _cells(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cell", p.value.alias("value"),
        parse.number_is_integer(F.col("cell")).alias("is_integer"), p.error.alias("problem"),
    )


@query(
    f"""SELECT {_KEYS}, CASE WHEN cell <> '' AND {_INT} IS NULL THEN 'level: invalid integer ''' || cell || ''''
    WHEN {_FLOAT} IS NULL THEN 'price: invalid float ''' || cell || '''' END AS problem,
    CASE WHEN {_INT} IS NOT NULL THEN {_FLOAT} END AS price FROM {_CELLS}"""
)
def first_parse_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell")
    level, price = parse.parse_nullable_int(cell), parse.parse_float(cell)
    return _cells(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cell",
        parse.first_error([("level", level), ("price", price)]).alias("problem"),
        parse.gated_value(price, [level]).alias("price"),
    )


@query(
    """WITH c AS (
      SELECT event_id, 'user' AS "column", 'integer' AS kind FROM events
      UNION ALL SELECT event_id, 'mixed', CASE event_type WHEN 'error' THEN 'text' WHEN 'click' THEN 'integer' ELSE 'float' END FROM events
      UNION ALL SELECT event_id, 'sparse', CASE WHEN event_type <> 'signup' THEN 'time' END FROM events
      UNION ALL SELECT event_id, 'props', 'generic' FROM events),
    s AS (SELECT "column", arg_min(kind, event_id) AS kind FROM c WHERE kind IS NOT NULL GROUP BY 1)
    SELECT s."column", s.kind,
      count(*) FILTER (s.kind <> 'generic' AND c.kind IS DISTINCT FROM s.kind) AS mismatches,
      min(event_id) FILTER (s.kind <> 'generic' AND c.kind IS DISTINCT FROM s.kind) AS first_mismatch
    FROM c JOIN s ON c."column" = s."column" GROUP BY 1, 2"""
)
def batch_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = lambda c: F.col(c).cast("variant")
    batch = table(spark, sf_dir, "events").select(
        "event_id",
        v("user_id").alias("user"),
        F.when(F.col("event_type") == "error", v("event_type"))
        .when(F.col("event_type") == "click", v("user_id"))
        .otherwise(v("value"))
        .alias("mixed"),
        F.when(F.col("event_type") != "signup", v("ts")).alias("sparse"),
        F.parse_json("props").alias("props"),
    )
    kinds = rows.batch_kinds(batch, ["user", "mixed", "sparse", "props"], ["event_id"])
    return kinds.withColumn("first_mismatch", F.col("first_mismatch.event_id"))


_NAMES = """(SELECT p_partkey AS id, p_brand || ' ' || p_name AS raw FROM part
    UNION ALL SELECT page_id, url FROM pages UNION ALL SELECT event_id, props FROM events)"""
_CLEAN = "upper(regexp_replace(trim(raw), '[^A-Za-z0-9_]', '_', 'g'))"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_name").alias("raw"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("raw"))
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("props").alias("raw"))
    return part.unionByName(pages).unionByName(events)


@query(
    f"""SELECT id, raw, CASE WHEN {_CLEAN} = '' THEN ''
    ELSE substr(CASE WHEN regexp_matches({_CLEAN}, '^[A-Z]') THEN {_CLEAN} ELSE 'X' || {_CLEAN} END, 1, 30) END AS name
    FROM {_NAMES}"""
)
def normalize_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).withColumn("name", names.normalize_identifiers(F.col("raw")))


_RAW_NAMES = """(SELECT p_partkey AS id, replace(p_brand, '#', '_') || '_' || replace(p_name, ' ', '_') || '_' || p_type AS raw FROM part
    UNION ALL SELECT page_id, url FROM pages UNION ALL SELECT event_id, event_type FROM events)"""


@query(
    f"""SELECT id, raw, CASE WHEN NOT regexp_full_match(raw, '[A-Za-z][A-Za-z0-9_]*') THEN 'identifier has illegal characters'
    WHEN length(raw) > 30 THEN 'identifier exceeds 30 characters' END AS problem FROM {_RAW_NAMES}"""
)
def validate_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = F.concat_ws("_", F.replace("p_brand", F.lit("#"), F.lit("_")), F.replace("p_name", F.lit(" "), F.lit("_")), "p_type")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), long.alias("raw"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("raw"))
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("raw"))
    every = part.unionByName(pages).unionByName(events)
    return every.withColumn("problem", names.identifier_errors(F.col("raw")))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS millis
    FROM events"""
)
def format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", times.format_seconds(ts).alias("seconds"), times.format_millis(ts).alias("millis")
    )


def _stamp_text() -> Column:
    return F.when(F.col("event_type") == "error", "unknown").otherwise(times.format_seconds(F.col("ts")))


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-01-01 00:00:00'
    ELSE date_trunc('second', ts) END AS committed_at FROM events"""
)
def parse_timestamp_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    fallback = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id", times.timestamp_or(_stamp_text(), fallback).alias("committed_at")
    )


@query(
    """SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 1e6 AS seconds FROM events"""
)
def seconds_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", times.seconds_between(noon, F.col("ts")).alias("seconds"))


@query("SELECT event_id, ts + INTERVAL 7 HOUR AS bangkok FROM events")
def bangkok_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.in_zone(F.col("ts")).alias("bangkok"))


@query(
    """SELECT event_id, user_id AS "user", value, event_type AS kind, ts AS at,
    (SELECT min(event_id) FROM events WHERE event_type = 'error' AND event_id > (SELECT min(event_id) FROM events)) AS first_mismatch FROM events"""
)
def bind_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped cells become typed columns; a column of two kinds is refused at its first odd cell."""
    events = table(spark, sf_dir, "events")
    v = lambda c: F.col(c).cast("variant")
    batch = events.select("event_id", v("user_id").alias("user"), v("value").alias("value"), v("event_type").alias("kind"), v("ts").alias("at"))
    first = events.agg(F.min("event_id")).first()[0]
    odd = (F.col("event_type") == "error") & (F.col("event_id") > first)
    mixed = events.select("event_id", F.when(odd, v("event_type")).otherwise(v("user_id")).alias("user"))
    refused = None
    try:
        rows.bind_batch(mixed, ["user"], ["event_id"])
    except rows.MixedColumn as e:
        refused = e.row[0]
    bound = rows.bind_batch(batch, ["user", "value", "kind", "at"], ["event_id"])
    return bound.withColumn("first_mismatch", F.lit(refused).cast("bigint"))
