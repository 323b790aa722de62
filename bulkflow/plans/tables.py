"""Catalog tables: create or replace, append, truncate, and where their files are.

Tables are external with a folder of their own below the given root, so a name can be
pointed at other files (refresh, exchange) without moving data.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkflow.functions.names import strict_name
from bulkflow.functions.types import ColumnDef, primary_key, struct_type
from bulkflow.plans import ledger
from bulkflow.session import children, delete_dir, fresh_table_dir, make_dir, quoted, sql_string

# Table properties: the declared columns, and folders below the table's own that belong to others.
DECLARED = "bulkflow.declared"
CEDED = "bulkflow.ceded"
PREVIOUS = "bulkflow.previous"


def location(spark: SparkSession, table: str, partition: str | None = None) -> str:
    """Folder of a table, or of one of its partitions given as a partition clause."""
    clause = f" PARTITION ({partition})" if partition else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {quoted(table)}{clause}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def _ddl(schema: T.StructType) -> str:
    parts = []
    for f in schema.fields:
        not_null = "" if f.nullable else " NOT NULL"
        parts.append(f"{quoted(f.name)} {f.dataType.simpleString()}{not_null}")
    return ", ".join(parts)


def create_or_replace(
    spark: SparkSession,
    table: str,
    columns: list[ColumnDef] | T.StructType,
    partitioned_by: list[str] | None = None,
    root: str | None = None,
) -> T.StructType:
    """Create an empty parquet table in a new folder; an existing one of that name goes.

    What is declared beyond Spark's types (length, key, NOT NULL) is kept with the table, see
    :func:`declared`; :func:`append` holds rows to it.
    """
    for part in table.split("."):
        strict_name(part)
    schema = columns if isinstance(columns, T.StructType) else struct_type(columns)
    path = make_dir(spark, root or fresh_table_dir(spark, table.replace(".", "_")))
    by = f" PARTITIONED BY ({', '.join(quoted(c) for c in partitioned_by)})" if partitioned_by else ""
    drop(spark, table)
    ledger.own(spark, path, table)
    spark.sql(f"CREATE TABLE {quoted(table)} ({_ddl(schema)}) USING parquet{by} LOCATION {sql_string(path)} TBLPROPERTIES ({sql_string(DECLARED)} = {sql_string(schema.json())})")
    return schema


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return next((r.value for r in rows if r.key == key), None)


def declared(spark: SparkSession, table: str) -> T.StructType:
    """The columns as declared: nullability, and metadata with length and key."""
    found = table_property(spark, table, DECLARED)
    return T.StructType.fromJson(json.loads(found)) if found else spark.table(table).schema


def create_over(spark: SparkSession, table: str, path: str) -> None:
    """Create or replace a table over rows that lie in a folder of their own already.

    A table with the same columns is pointed at the new folder, so that it is there all the time;
    the old folder stays for readers that are under way until the next such change.
    """
    schema = spark.read.parquet(path).schema
    if spark.catalog.tableExists(table) and not _is_partitioned(spark, table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
            replace_files(spark, table, path)
            return
    create_or_replace(spark, table, schema, root=path)


def replace_files(spark: SparkSession, table: str, path: str) -> None:
    """Point a table at a new folder and delete the folder of the change before the last."""
    old = location(spark, table)
    before = table_property(spark, table, PREVIOUS)
    point(spark, table, path)
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({sql_string(PREVIOUS)} = {sql_string(old)})")
    if before and before not in (old, path) and not ledger.owners(spark, before):
        delete_dir(spark, before)


def drop(spark: SparkSession, table: str) -> None:
    """Drop a table and delete its files."""
    if spark.catalog.tableExists(table):
        path = location(spark, table)
        ceded = ceded_folders(spark, table)
        previous = table_property(spark, table, PREVIOUS)
        elsewhere = [] if not _is_partitioned(spark, table) else _partition_folders(spark, table, path)
        spark.sql(f"DROP TABLE {quoted(table)}")
        ledger.disown(spark, path, table)
        # Folders that an exchange gave away lie below this one but belong to another table.
        if any(c.startswith(f"{path}/") for c in ceded):
            for child in children(spark, path):
                if child not in ceded:
                    delete_dir(spark, child)
        elif not ledger.owners(spark, path):
            delete_dir(spark, path)
        for spec, folder in elsewhere:
            ledger.disown(spark, folder, f"{table}/{spec}")
            if not ledger.owners(spark, folder):
                delete_dir(spark, folder)
        if previous and not ledger.owners(spark, previous):
            delete_dir(spark, previous)


def ceded_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders below the table's own that now belong to other tables."""
    return [c for c in (table_property(spark, table, CEDED) or "").split("\n") if c]


def cede(spark: SparkSession, table: str, folder: str) -> None:
    """Remember that a folder below the table's own was given away."""
    kept = sorted({*ceded_folders(spark, table), folder})
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({sql_string(CEDED)} = {sql_string(chr(10).join(kept))})")


def _partition_folders(spark: SparkSession, table: str, root: str) -> list[tuple[str, str]]:
    """(partition clause, folder) of partitions that do not lie below the table's own folder."""
    specs = [partition_clause(r.partition) for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]
    return [(s, f) for s, f in ((s, location(spark, table, s)) for s in specs) if not f.startswith(f"{root}/")]


def append(df: DataFrame, table: str) -> int:
    """Append rows, columns matched by name; all rows or none become visible. Gives the count.

    A row that the table cannot hold as it is fails the whole append: a value that its column's
    type would change, a NULL in a NOT NULL column, a text longer than declared, a declared key that
    another row of the batch or the table has.
    """
    spark = df.sparkSession
    target = spark.table(table)
    if not df.columns:
        raise ValueError("the batch has no columns")
    given = {c.lower(): c for c in df.columns}
    unknown = [c for low, c in given.items() if low not in {t.lower() for t in target.columns}]
    if unknown:
        raise ValueError(f"{table} has no columns {unknown}")
    rules = {f.name.lower(): f for f in declared(spark, table).fields}
    aligned = df.select(
        *[
            _held(F.col(quoted(given[c.lower()])), df.schema[given[c.lower()]].dataType, target.schema[c], rules.get(c.lower()))
            if c.lower() in given
            else _held(F.lit(None), T.NullType(), target.schema[c], rules.get(c.lower()))
            for c in target.columns
        ]
    )
    key = primary_key(declared(spark, table))
    if key:
        aligned = with_new_keys(aligned, target, key)
    counter = Observation()
    aligned.observe(counter, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return counter.get.get("rows", 0)


def with_new_keys(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """``rows``, refused in the plan that writes them if a key occurs twice in them or in ``existing`` already.

    Only key columns are read for it, and the key groups are counted with map-side combining.  A key
    with a null is no key.
    """
    counted = rows.select(*key).dropna().groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    spelled = F.concat_ws(", ", *(F.col(k).cast("string") for k in key))
    twice = counted.filter(F.col("_n") > 1).select(F.concat(F.lit("key "), spelled, F.lit(" occurs more than once")).alias("why"))
    there = counted.join(existing.select(*key), key, "left_semi").select(F.concat(F.lit("key "), spelled, F.lit(" is in the table already")).alias("why"))
    why = twice.union(there).agg(F.min("why")).scalar()
    return rows.filter(F.when(why.isNull(), True).otherwise(F.raise_error(why).cast("boolean")))


def _held(value: Column, kind: T.DataType, target: T.StructField, rule: T.StructField | None) -> Column:
    """The value in the target's type; a value that does not fit raises an error when it is written."""
    name, wanted = target.name, target.dataType
    if kind == wanted:
        out, bad = value, F.lit(False)
    elif isinstance(kind, T.NullType):
        out, bad = value.cast(wanted), F.lit(False)
    elif isinstance(kind, T.AtomicType) and isinstance(wanted, T.AtomicType):
        out = value.try_cast(wanted)
        same = F.lit(True) if isinstance(wanted, T.StringType) else out.try_cast(kind).eqNullSafe(value)
        if isinstance(kind, T.StringType) and not isinstance(wanted, T.StringType):
            same = F.lit(True)  # spelling may differ; that it can be read is all there is to check
        if isinstance(kind, (T.FloatType, T.DoubleType)) and isinstance(wanted, T.DecimalType):
            same = out.cast("double").eqNullSafe(value.cast("double"))
        bad = value.isNotNull() & (out.isNull() | ~same)
    else:
        out, bad = value.cast(wanted), F.lit(False)
    reasons = [F.when(bad, F.concat(F.lit(f"{name} cannot hold "), value.cast("string")))]
    if rule is not None and not rule.nullable:
        reasons.append(F.when(out.isNull(), F.lit(f"{name} must not be null")))
    if rule is not None and isinstance(wanted, T.StringType) and rule.metadata.get("length"):
        length = rule.metadata["length"]
        reasons.append(F.when(F.length(out) > length, F.lit(f"{name} takes at most {length} characters")))
    reason = F.coalesce(*reasons)
    return F.when(reason.isNull(), out).otherwise(F.raise_error(reason).cast(wanted)).alias(name)


def truncate(spark: SparkSession, table: str) -> None:
    """Empty a table by pointing it at an empty folder; running readers keep their files.

    A partitioned table loses all its partitions in one statement, and partitions that come later go
    to the new folder too.  The old folders have no owner any more; :func:`ledger.vacuum` deletes them.
    """
    old = location(spark, table)
    if _is_partitioned(spark, table):
        elsewhere = _partition_folders(spark, table, old)
        drop_partitions(spark, table, [partition_clause(r.partition) for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()])
        for spec, folder in elsewhere:
            ledger.disown(spark, folder, f"{table}/{spec}")
    point(spark, table, make_dir(spark, fresh_table_dir(spark, table.replace(".", "_"))))


def drop_partitions(spark: SparkSession, table: str, specs: list[str]) -> None:
    """Take partitions, given as clauses, out of the catalog in one statement; no files are deleted."""
    if specs:
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def point(spark: SparkSession, table: str, path: str, partition: str | None = None) -> None:
    """Make a table, or one partition of it, read its rows from ``path``."""
    clause = f" PARTITION ({partition})" if partition else ""
    old = location(spark, table, partition)
    owner = f"{table}/{partition}" if partition else table
    ledger.own(spark, path, owner)
    spark.sql(f"ALTER TABLE {quoted(table)}{clause} SET LOCATION {sql_string(path)}")
    spark.catalog.refreshTable(table)
    ledger.move(spark, old, path, owner)


def partition_clause(spec: str) -> str:
    """``a=x/b=y`` as SHOW PARTITIONS prints it -> a partition clause."""
    parts = []
    for item in spec.split("/"):
        name, value = item.split("=", 1)
        parts.append(f"{quoted(name)}={sql_string(unquote(value))}")
    return ", ".join(parts)


def write_fresh(df: DataFrame, label: str, max_rows_per_file: int = 0) -> tuple[str, int]:
    """Write rows to a folder of their own; gives the folder and the row count."""
    path = fresh_table_dir(df.sparkSession, label)
    counter = Observation()
    writer = df.observe(counter, F.count(F.lit(1)).alias("rows")).write
    if max_rows_per_file > 0:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)
    return path, counter.get.get("rows", 0)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """CSV sink; quotes inside quoted cells are doubled, NULL and '' are both empty cells."""
    df.write.options(sep=sep, header=header, escape='"', emptyValue="").csv(path)


@dataclass(frozen=True)
class LoadReport:
    """What one load did; times in seconds.

    Writing stages the rows (insert), publishing is the commit: the switch that makes them
    visible and, in a reload, the refresh of the published name.
    """

    rows: int
    write_seconds: float
    publish_seconds: float
    refresh_seconds: float = 0.0

    @property
    def total_seconds(self) -> float:
        return self.write_seconds + self.publish_seconds

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The report as one row: rows, insert, commit, refresh and total seconds."""
        commit = self.publish_seconds - self.refresh_seconds
        values = (self.rows, self.write_seconds, commit, self.refresh_seconds, self.total_seconds)
        names = "rows long, insert_seconds double, commit_seconds double, refresh_seconds double, total_seconds double"
        return spark.createDataFrame([values], names)


class Stopwatch:
    def __init__(self) -> None:
        self._last = time.monotonic()

    def lap(self) -> float:
        now = time.monotonic()
        taken, self._last = now - self._last, now
        return taken
