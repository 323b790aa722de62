"""Versioned tables: immutable files, and a manifest per version that says which of them count.

A table is a folder with ``data`` (parquet files that never change once written), ``versions``
(the manifests, numbered) and ``schema``.  A manifest has a row for each file: its partition, its
rows, the bounds of the key, a digest of its content.  A change writes its new files first and then
takes the next version number by a rename that fails when another writer was faster; the loser
applies its change to the newer version and tries again.  So readers see all of a change or nothing,
racing writers lose nothing, and what a manifest knows (counts, bounds, digests) needs no scan.

A merge rewrites only the files that hold a matched key; all others keep their names.  Rows are
written in ranges of the key, so that files have narrow bounds and a feed opens few of them.

What reaches the driver is file metadata, never rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkflow.operators.audit import foreign_key_violations
from bulkflow.operators.merge import upsert
from bulkflow.plans import ledger
from bulkflow.plans.partitions import INITIAL, UNDATED
from bulkflow.session import cut_lineage, delete_dir, list_dirs, modified, rename_new

#: How often a change is tried again after another writer was faster.
ATTEMPTS = 20
#: The largest sum of row digests: 64-bit numbers added up without overflow.
DIGEST = "decimal(38,0)"
_PART = "_bulkflow_part"


class Conflict(RuntimeError):
    """Other writers were faster each time."""


class Refused(ValueError):
    """Rows that break a rule of the table."""


def content_digest(df: DataFrame) -> Column:
    """Aggregate: a number that is the same for equal multisets of rows, whatever their order.

    The sum of a hash of every row; columns count by their names, in name order.
    """
    names = sorted(df.columns)
    # Nulls leave a hash as it is, hence the marks.
    row = F.xxhash64(*(F.col(c) for c in names), *(F.col(c).isNull() for c in names))
    return F.coalesce(F.sum(row.cast(DIGEST)), F.lit(0)).cast(DIGEST)


@dataclass
class Reference:
    """A column whose values must be keys of another table."""

    column: str
    parent: Callable[[], DataFrame]
    key: str


@dataclass
class VersionedTable:
    """A table below ``path``; ``keys`` cluster its files and are unique if ``unique``.

    ``rows_per_file`` bounds the rows of a file (0: one file per task and partition).
    """

    spark: SparkSession
    path: str
    keys: list[str] = field(default_factory=list)
    partition: str | None = None
    unique: bool = False
    references: list[Reference] = field(default_factory=list)
    rows_per_file: int = 0

    # -- versions --------------------------------------------------------------------------

    def create(self, schema: T.StructType) -> "VersionedTable":
        """An empty table, version 0; refused when the folder holds one already."""
        for c in [*self.keys, *([self.partition] if self.partition else [])]:
            if c not in schema.names:
                raise ValueError(f"the table has no column {c}")
        if self.unique and not self.keys:
            raise ValueError("a unique table needs keys")
        ledger.own(self.spark, self.path, "versions")
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(f"{self.path}/schema")
        if not self._take(0, self._entries_of(empty)):
            raise FileExistsError(f"{self.path} holds a table already")
        return self

    def _versions(self) -> list[int]:
        names = [p.rsplit("/", 1)[1] for p in list_dirs(self.spark, f"{self.path}/versions")]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no table below {self.path}")
        return versions[-1]

    def files(self, version: int | None = None) -> DataFrame:
        """(file, part, rows, low, high, digest): the manifest, one row per file."""
        return self.spark.read.parquet(self._manifest(self.version() if version is None else version))

    def _manifest(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}"

    def schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def read(self, version: int | None = None) -> DataFrame:
        return self._read_files(self._names(self.files(version)))

    def read_partitions(self, values: list[str], version: int | None = None) -> DataFrame:
        """Rows of some partitions; no other file is listed or opened."""
        return self._read_files(self._names(self.files(version).where(F.col("part").isin(values))))

    def _names(self, entries: DataFrame) -> list[str]:
        return sorted(r.file for r in entries.select("file").collect())

    def _read_files(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema())
        return self.spark.read.schema(self.schema()).parquet(*(f"{self.path}/data/{n}" for n in names))

    # -- writing files and taking versions -------------------------------------------------

    def _take(self, version: int, entries: DataFrame) -> bool:
        """Try to make ``entries`` the version of that number."""
        staged = f"{self.path}/versions/_staged-{uuid.uuid4().hex}"
        entries.write.parquet(staged)
        taken = rename_new(self.spark, staged, self._manifest(version))
        if not taken:
            delete_dir(self.spark, staged)
        return taken

    def _commit(self, change: Callable[[int, DataFrame], DataFrame]) -> int:
        """Apply a change of the manifest to the newest version, again when another writer is faster."""
        for _ in range(ATTEMPTS):
            base = self.version()
            if self._take(base + 1, change(base, self.files(base))):
                return base + 1
        raise Conflict(f"{self.path} was changed by others {ATTEMPTS} times")

    def _write(self, df: DataFrame) -> DataFrame:
        """Write rows to new files and describe them; nobody reads them until a version names them."""
        batch = uuid.uuid4().hex
        folder = f"{self.path}/data/{batch}"
        rows = df.select(*self.schema().names)
        if self.partition:
            # One value per file; the hash is safe in a path whatever the value.
            part = F.col(self.partition)
            checked = F.when(part.isNotNull(), F.md5(part.cast("string"))).otherwise(F.raise_error(F.lit("a row has no partition")).cast("string"))
            rows = rows.withColumn(_PART, checked)
        order = [*([_PART] if self.partition else []), *self.keys]
        laid = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
        writer = laid.write.option("maxRecordsPerFile", self.rows_per_file)
        (writer.partitionBy(_PART) if self.partition else writer).parquet(folder)
        # Explicit schema: the part folders are names only.
        written = self.spark.read.option("recursiveFileLookup", True).schema(self.schema()).parquet(folder)
        return cut_lineage(self._entries_of(written))

    def _entries_of(self, rows: DataFrame) -> DataFrame:
        file = F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -3 if self.partition else -2, 3))
        named = rows.withColumn("_file", file) if rows.inputFiles() else rows.withColumn("_file", F.lit("").cast("string"))
        part = F.max(F.col(self.partition).cast("string")) if self.partition else F.lit(None).cast("string")
        low, high = (self._bound(f) for f in (F.min, F.max))
        return named.groupBy("_file").agg(
            part.alias("part"), F.count(F.lit(1)).alias("rows"), low.alias("low"), high.alias("high"), content_digest(rows).alias("digest")
        ).withColumnRenamed("_file", "file")

    def _bound(self, f: Callable[[str], Column]) -> Column:
        """The first key's least or largest value in a file; null without keys or values."""
        return f(self.keys[0]) if self.keys else F.lit(None).cast("string")

    def _overlapping(self, entries: DataFrame, low: object, high: object) -> DataFrame:
        """Files that may hold a first key between two bounds."""
        kind = self.schema()[self.keys[0]].dataType
        return entries.where((F.col("low") <= F.lit(high).cast(kind)) & (F.col("high") >= F.lit(low).cast(kind)))

    # -- rules -----------------------------------------------------------------------------

    def _present(self, keys: DataFrame, entries: DataFrame) -> DataFrame:
        """Keys (without nulls) that rows of the given files hold, with the file; only key columns of files in reach are read."""
        low, high = keys.agg(F.min(self.keys[0]), F.max(self.keys[0])).first()
        if low is None:
            return self.spark.createDataFrame([], T.StructType([*(self.schema()[k] for k in self.keys), T.StructField("_file", T.StringType())]))
        stored = self._read_files(self._names(self._overlapping(entries, low, high)))
        tagged = stored.select(*self.keys, F.col("_metadata.file_path").alias("_path")) if stored.inputFiles() else stored.select(*self.keys, F.lit("").alias("_path"))
        file = F.concat_ws("/", F.slice(F.split("_path", "/"), -3 if self.partition else -2, 3))
        return tagged.join(keys.select(*self.keys), self.keys, "left_semi").withColumn("_file", file).drop("_path")

    def _refuse_broken(self, df: DataFrame, entries: DataFrame) -> None:
        """Refuse rows that repeat a key, of the batch or of the table, or that refer to nothing."""
        if self.unique:
            named = df
            for k in self.keys:
                if not df.where(F.col(k).isNull()).isEmpty():
                    raise Refused(f"{k} must not be null")
            counted = named.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
            twice = counted.where("n > 1").drop("n").first()
            if twice is not None:
                raise Refused(f"key {tuple(twice)} occurs more than once")
            known = self._present(counted, entries).select(*self.keys).first()
            if known is not None:
                raise Refused(f"key {tuple(known)} is in the table already")
        for r in self.references:
            orphan = foreign_key_violations(df, r.column, r.parent(), r.key).select(r.column).first()
            if orphan is not None:
                raise Refused(f"{r.column} {orphan[0]} has no parent")

    # -- changes ---------------------------------------------------------------------------

    def append(self, df: DataFrame) -> int:
        """Add rows; gives the version that has them.  A unique table refuses keys that it has.

        The batch is written once.  Against versions that came up meanwhile only the keys of their
        new files are compared again.
        """
        ruled = self.unique or bool(self.references)
        rows = cut_lineage(df.select(*self.schema().names)) if ruled else df
        checked = self.version()
        if ruled:
            self._refuse_broken(rows, self.files(checked))
        new = self._write(rows)

        def change(base: int, entries: DataFrame) -> DataFrame:
            nonlocal checked
            if self.unique and base != checked:
                later = entries.join(self.files(checked).select("file"), "file", "left_anti")
                known = self._present(rows.select(*self.keys), later).select(*self.keys).first()
                if known is not None:
                    raise Refused(f"key {tuple(known)} is in the table already")
                checked = base
            return entries.unionByName(new)

        return self._commit(change)

    def replace(self, df: DataFrame) -> int:
        """All rows anew, in one version."""
        new = self._write(df)
        return self._commit(lambda base, entries: new)

    def truncate(self) -> int:
        return self._commit(lambda base, entries: entries.limit(0))

    def merge(self, source: DataFrame, order: list[str] | None = None, distinct_order: bool = False) -> int:
        """Upsert by the keys (see :func:`bulkflow.operators.merge.upsert`), rewriting only files with a matched key.

        Unmatched rows go to new files.  When others commit meanwhile, the merge starts again only if
        they touched its files or added files that may hold its keys.
        """
        if not self.keys:
            raise ValueError("a merge needs keys")
        source = cut_lineage(source)
        keyed = source.dropna(subset=self.keys)
        for _ in range(ATTEMPTS):
            base = self.version()
            before = self.files(base)
            keys = cut_lineage(keyed.select(*self.keys).distinct())
            touched = sorted(r[0] for r in self._present(keys, before).select("_file").distinct().collect())
            new = self._write(upsert(self._read_files(touched), source, self.keys, order, distinct_order))
            while True:
                now = self.version()
                entries = self.files(now)
                if now != base and not self._unharmed(before, entries, touched, keys):
                    break
                if self._take(now + 1, entries.where(~F.col("file").isin(touched)).unionByName(new)):
                    return now + 1
        raise Conflict(f"{self.path} was changed by others {ATTEMPTS} times")

    def _unharmed(self, before: DataFrame, now: DataFrame, touched: list[str], keys: DataFrame) -> bool:
        """Whether a merge computed on ``before`` still holds: its files are there and no new file has its keys."""
        if now.where(F.col("file").isin(touched)).count() < len(touched):
            return False
        return self._present(keys, now.join(before.select("file"), "file", "left_anti")).isEmpty()

    # -- partitions: every change is one version, whatever the number of partitions ---------

    def partitions(self, version: int | None = None) -> DataFrame:
        """(partition, row_count, files, low, high) from the manifest; no rows are read."""
        found = self.files(version).groupBy(F.col("part").alias("partition"))
        return found.agg(F.sum("rows").alias("row_count"), F.count(F.lit(1)).alias("files"), F.min("low").alias("low"), F.max("high").alias("high"))

    def row_count(self, version: int | None = None) -> int:
        return self.files(version).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def digest(self, version: int | None = None) -> DataFrame:
        """(row_count, digest) of a version, from its manifest: equal for equal multisets of rows."""
        total = F.coalesce(F.sum("digest"), F.lit(0)).cast(DIGEST)
        return self.files(version).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), total.alias("digest"))

    def drop_partitions(self, values: list[str]) -> int:
        return self._commit(lambda base, entries: entries.where(~F.col("part").isin(values)))

    def replace_partition(self, value: str, df: DataFrame) -> int:
        """All rows of one partition anew; rows of another partition are refused."""
        new = self._write(df)
        if not new.where(F.col("part") != value).isEmpty():
            raise Refused(f"rows do not belong to partition {value}")
        return self._commit(lambda base, entries: entries.where(F.col("part") != value).unionByName(new))

    def retain_latest(self) -> int:
        """Drop all partitions but the latest, the initial and the undated one, in one version."""

        def change(base: int, entries: DataFrame) -> DataFrame:
            dated = entries.where(~F.col("part").isin(INITIAL, UNDATED))
            latest = dated.agg(F.max("part").alias("part")).first()[0]
            return entries.where(F.col("part").isin(INITIAL, UNDATED, *([latest] if latest else [])))

        return self._commit(change)

    def rolling_replace(self, df: DataFrame) -> int:
        """Add new rows and drop the older partitions, in one version."""
        new = self._write(df)
        kept = [INITIAL, UNDATED]

        def change(base: int, entries: DataFrame) -> DataFrame:
            both = entries.unionByName(new)
            latest = both.where(~F.col("part").isin(kept)).agg(F.max("part")).first()[0]
            return both.where(F.col("part").isin(*kept, *([latest] if latest else [])))

        return self._commit(change)

    def exchange(self, value: str, other: "VersionedTable") -> None:
        """Swap one partition's rows with all rows of an unpartitioned table of the same columns otherwise.

        The other table's rows are copied once, into files of this one; both sides change by one version each.
        """
        mine = [f for f in self.schema().fields if f.name != self.partition]
        theirs = other.schema().fields
        if [(f.name, f.dataType) for f in mine] != [(f.name, f.dataType) for f in theirs]:
            raise ValueError("the columns of the two tables differ")
        outgoing = cut_lineage(self.read_partitions([value]).drop(self.partition))
        self.replace_partition(value, other.read().withColumn(self.partition, F.lit(value)))
        other.replace(outgoing)

    # -- files nobody needs ----------------------------------------------------------------

    def vacuum(self, keep: int = 2, grace_seconds: float = 3600.0) -> int:
        """Delete files that none of the newest ``keep`` versions name, left by old versions or failed writers.

        Files younger than the grace time stay: a writer may be about to commit them.  Readers of the
        kept versions lose nothing.  Gives the number of deleted files.
        """
        versions = self._versions()
        if keep < 1:
            raise ValueError("at least the newest version stays")
        kept = versions[-keep:]
        named = self.files(kept[0]).select("file")
        for v in kept[1:]:
            named = named.union(self.files(v).select("file"))
        limit = F.timestamp_seconds(F.lit(time.time() - grace_seconds))
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        found = 0
        if list_dirs(self.spark, f"{self.path}/data"):
            # Names and times only: the content column is not read.
            all_files = listed.load(f"{self.path}/data").select("path", "modificationTime")
            file = F.concat_ws("/", F.slice(F.split("path", "/"), -3 if self.partition else -2, 3))
            old = all_files.where(F.col("modificationTime") <= limit).withColumn("file", file).join(named.distinct(), "file", "left_anti")
            for r in old.select("file").toLocalIterator():
                found += delete_dir(self.spark, f"{self.path}/data/{r.file}")
        for v in versions[:-keep]:
            delete_dir(self.spark, self._manifest(v))
        for folder in list_dirs(self.spark, f"{self.path}/versions"):
            if folder.rsplit("/", 1)[1].startswith("_staged-") and modified(self.spark, folder) / 1000 <= time.time() - grace_seconds:
                delete_dir(self.spark, folder)
        return found
