"""Loads that start from a file: create-and-load, upsert, exchange."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

from bulkflow.functions.names import normalize_name
from bulkflow.operators.merge import upsert
from bulkflow.plans import tables
from bulkflow.plans.partitions import PartitionedTable
from bulkflow.plans.publish import Snapshot
from bulkflow.plans.versions import VersionedTable
from bulkflow.session import delete_dir
from bulkflow.sources.typed_csv import TypedCsv


def table_name(path: str, name: str | None = None) -> str:
    """The given name, each part normalized, or the file's base name."""
    if name and name.strip():
        parts = [normalize_name(p) for p in name.split(".")]
    else:
        parts = [normalize_name(PurePosixPath(path).stem)]
    if not all(parts):
        raise ValueError(f"cannot derive a valid table name from {name or path!r}")
    return ".".join(parts)


def load_csv(spark: SparkSession, path: str, name: str | None = None, **options) -> str:
    """Create or replace a table from a typed CSV file; all rows or none are loaded."""
    table = table_name(path, name)
    staged, _ = TypedCsv(spark, path, **options).stage()
    tables.create_over(spark, table, staged)
    return table


def upsert_csv(spark: SparkSession, path: str, target: Snapshot | VersionedTable, keys: list[str], **options) -> int:
    """Merge a typed CSV file into a published snapshot; of repeated keys the last row wins.

    A snapshot is written anew; of a versioned table only the files with a matched key are.
    """
    source = TypedCsv(spark, path, **options)
    names = [n for n, _ in source.columns]
    normalized = [normalize_name(k) for k in keys]
    missing = [k for k in normalized if k not in names]
    if not normalized or missing:
        raise ValueError(f"the file does not have the keys {missing}" if keys else "a merge needs keys")
    staged, rows = source.stage(row_number=True)
    try:
        if rows:
            feed = spark.read.parquet(staged)
            if isinstance(target, VersionedTable):
                if [normalize_name(k) for k in target.keys] != normalized:
                    raise ValueError(f"the table is keyed by {target.keys}")
                target.merge(feed, ["_row"], distinct_order=True)
            else:
                target.publish(upsert(target.read(), feed, normalized, ["_row"], distinct_order=True))
    finally:
        delete_dir(spark, staged)
    return rows


def exchange_csv(
    spark: SparkSession,
    path: str,
    master: str,
    staging: str,
    partition: str,
    column: str = "_part",
    rule: Column | None = None,
    drop_old: bool = False,
    **options,
) -> int:
    """Load a typed CSV file into the staging table and exchange it with one partition."""
    for what, value in (("master table", master), ("staging table", staging), ("partition", partition), ("file", path)):
        if not value or not value.strip():
            raise ValueError(f"{what} is required")
    table = PartitionedTable(spark, master, column)
    wanted = T.StructType([f for f in table.read().schema.fields if f.name != column])
    staged, _ = TypedCsv(spark, path, **options).stage()
    data = spark.read.parquet(staged)
    absent = [f.name for f in wanted.fields if f.name not in data.columns]
    if absent:
        raise ValueError(f"file lacks columns {absent} of {master}")
    staging_name = table_name(path, staging)
    tables.create_or_replace(spark, staging_name, wanted)
    try:
        rows = tables.append(data.select(*[f.name for f in wanted.fields]), staging_name)
    finally:
        delete_dir(spark, staged)
    table.exchange(partition, staging_name, rule, drop_old)
    return rows
