"""Partitioned tables: routing, listing, statistics, exchange and retention."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bulkflow.functions.times import plus_micros
from bulkflow.plans import ledger, tables
from bulkflow.session import delete_dir, fresh_table_dir, make_dir, quoted, sql_string

log = logging.getLogger(__name__)

# Fixed value: the name of the partition for all rows before the first day.
INITIAL = "P_INITIAL"
# Rows without a time stamp go here; like the initial partition it is never dropped as old.
UNDATED = "P_UNDATED"
# Fixed value: rows of earlier days go to the initial partition.
FIRST_DAY = "2024-01-01"
# About as many rows of one partition are written, and sorted for it, by one task of an append.
ROWS_PER_TASK = 1_000_000


def day_partition(ts: Column, first_day: str = FIRST_DAY) -> Column:
    """Partition of a row by day: the day as text, the initial partition before the first day,
    a partition of their own for rows without a time."""
    day = F.to_date(ts)
    return F.when(day.isNull(), UNDATED).when(day < F.lit(first_day).cast("date"), INITIAL).otherwise(F.date_format(day, "yyyy-MM-dd"))


def second_partition(ts: Column) -> Column:
    return F.concat(F.lit("P_"), F.date_format(ts, "yyyyMMddHHmmss"))


def second_high_value(ts: Column) -> Column:
    """Upper bound of the one-second partition, as text."""
    return F.date_format(plus_micros(ts, F.lit(1_000_000).cast("bigint")), "yyyyMMdd HH:mm:ss")


def _dealt(routed: DataFrame, column: str) -> DataFrame:
    """Rows of a partition together, those of a large one in parts of about :data:`ROWS_PER_TASK` rows.

    The part is a hash of the row, so a task that is tried again deals its rows alike.  At most one
    partition in :data:`ROWS_PER_TASK` rows is large, so the table of large ones is small.
    """
    value = F.col(quoted(column))
    sizes = routed.groupBy(value.alias("__value")).agg(F.count(F.lit(1)).alias("__rows"))
    large = sizes.filter(F.col("__rows") > ROWS_PER_TASK).select("__value", F.ceil(F.col("__rows") / ROWS_PER_TASK).alias("__parts"))
    hashed = [F.col(quoted(f.name)) for f in routed.schema.fields if _has_hash(f.dataType)]
    joined = routed.join(F.broadcast(large), value == F.col("__value"), "left")
    dealt = joined.withColumn("__part", F.pmod(F.xxhash64(*hashed), F.coalesce("__parts", F.lit(1))))
    return dealt.hint("rebalance", column, "__part").select(*[F.col(quoted(c)) for c in routed.columns])


def _has_hash(kind: T.DataType) -> bool:
    return not any(word in kind.simpleString() for word in ("map<", "variant"))


@dataclass
class PartitionedTable:
    """An external parquet table with one text partition column that is stored, not derived."""

    spark: SparkSession
    name: str
    column: str = "_part"

    # -- creating and loading ------------------------------------------------------------

    def create(self, schema: T.StructType) -> "PartitionedTable":
        full = T.StructType([f for f in schema.fields if f.name != self.column])
        tables.create_or_replace(self.spark, self.name, full.add(self.column, "string"), [self.column])
        return self

    def append(self, df: DataFrame) -> int:
        """Add rows; partitions that are new appear by themselves.

        The rebalance gathers a partition's rows into few files.  A partition with many rows is
        dealt over several tasks by its row count; the sizes that Spark splits by are compressed,
        and equal times or labels hide many rows in few bytes.  A row without a partition value
        fails the append.
        """
        ours = next((c for c in df.columns if c.lower() == self.column.lower()), None)
        if ours is None:
            raise ValueError(f"rows need the partition column {self.column}")
        missing = F.raise_error(F.lit(f"a row for {self.name} has no partition")).cast("string")
        routed = df.withColumn(ours, F.coalesce(F.col(quoted(ours)).cast("string"), missing))
        self._apart_from_ceded()
        return tables.append(_dealt(routed, ours), self.name)

    def _apart_from_ceded(self) -> None:
        """Give partitions whose usual folder now belongs to another table a folder of their own."""
        known = set(self.values())
        for folder in tables.ceded_folders(self.spark, self.name):
            value = unquote(folder.rsplit("/", 1)[1].split("=", 1)[1])
            if value not in known:
                self._add_empty(value)

    def _add_empty(self, value: str) -> None:
        empty = make_dir(self.spark, fresh_table_dir(self.spark, "partition"))
        ledger.own(self.spark, empty, f"{self.name}/{self._clause(value)}")
        self.spark.sql(f"ALTER TABLE {quoted(self.name)} ADD PARTITION ({self._clause(value)}) LOCATION {sql_string(empty)}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def partition(self, value: str) -> DataFrame:
        """Rows of one partition; the scan only opens its files."""
        return self.read().filter(F.col(self.column) == value)

    # -- catalog metadata ----------------------------------------------------------------

    def values(self) -> list[str]:
        """Partition values in position order: the initial one first, then undated rows, then by value."""
        rows = self.spark.sql(f"SHOW PARTITIONS {quoted(self.name)}").collect()
        found = [unquote(r.partition.split("=", 1)[1]) for r in rows]
        return sorted(found, key=lambda v: (v != INITIAL, v != UNDATED, v))

    def _clause(self, value: str) -> str:
        return f"{quoted(self.column)}={sql_string(value)}"

    def latest(self) -> str | None:
        """The last partition; never the initial or the undated one when there is another."""
        values = self.values()
        dated = [v for v in values if v not in (INITIAL, UNDATED)]
        return dated[-1] if dated else values[-1] if values else None

    def listing(self) -> DataFrame:
        """Partition, position and row count; partitions without rows count 0.

        One row per partition reaches the window, whatever the table holds.
        """
        counts = self.read().groupBy(self.column).agg(F.count(F.lit(1)).alias("row_count"))
        known = self.spark.createDataFrame([(v,) for v in self.values()], f"`{self.column}` string")
        order = Window.orderBy(F.col("partition") != INITIAL, F.col("partition") != UNDATED, "partition")
        return (
            known.join(counts, self.column, "left")
            .select(F.col(self.column).alias("partition"), F.coalesce("row_count", F.lit(0)).alias("row_count"))
            .withColumn("position", F.row_number().over(order).cast("bigint"))
        )

    def stats(self) -> DataFrame:
        """Rows per partition by a full count."""
        return self.read().groupBy(F.col(self.column).alias("partition")).agg(F.count(F.lit(1)).alias("row_count"))

    def analyze(self) -> None:
        """Store full row counts per partition in the catalog."""
        self.spark.sql(
            f"ANALYZE TABLE {quoted(self.name)} PARTITION ({quoted(self.column)}) COMPUTE STATISTICS"
        )

    def distribution(self) -> DataFrame:
        """Each partition beside the row count of the whole table (see :meth:`stats` for its own)."""
        total = self.read().agg(F.count(F.lit(1))).scalar()
        return self.stats().select("partition", total.alias("row_count"))

    # -- exchange ------------------------------------------------------------------------

    def violations(self, staging: str, rule: Column) -> DataFrame:
        """Staging rows that do not belong into the partition."""
        return self.spark.table(staging).filter(~F.coalesce(rule, F.lit(False)))

    def exchange(self, value: str, staging: str, rule: Column | None = None, drop_old: bool = False) -> None:
        """Swap the contents of one partition with an unpartitioned staging table.

        Only catalog entries change: both sides keep their files and trade folders.  With a
        ``rule`` every staging row must satisfy it, without one rows enter unchecked.
        """
        ours = [(f.name, f.dataType) for f in self.read().schema.fields if f.name != self.column]
        theirs = [(f.name, f.dataType) for f in self.spark.table(staging).schema.fields]
        if ours != theirs:
            raise ValueError(f"column mismatch in exchange: {ours} and {theirs}")
        if rule is not None and not self.violations(staging, rule).isEmpty():
            raise ValueError(f"rows of {staging} do not belong to partition {value}")
        if value not in self.values():
            self._add_empty(value)
        incoming = tables.location(self.spark, staging)
        outgoing = tables.location(self.spark, self.name, self._clause(value))
        if outgoing.startswith(tables.location(self.spark, self.name) + "/"):
            tables.cede(self.spark, self.name, outgoing)
        tables.point(self.spark, self.name, incoming, self._clause(value))
        tables.point(self.spark, staging, outgoing)
        if drop_old:
            tables.truncate(self.spark, staging)
            delete_dir(self.spark, outgoing)

    def load_and_exchange(
        self, df: DataFrame, value: str, staging: str, rule: Column | None = None, drop_old: bool = False
    ) -> int:
        """Create the staging table from ``df`` (in a folder of its own) and exchange it in."""
        tables.create_or_replace(self.spark, staging, df.schema)
        rows = tables.append(df, staging)
        self.exchange(value, staging, rule, drop_old)
        return rows

    # -- retention -----------------------------------------------------------------------

    def truncate_partition(self, value: str) -> None:
        """Empty one partition; it stays in the listing."""
        old = tables.location(self.spark, self.name, self._clause(value))
        tables.point(self.spark, self.name, make_dir(self.spark, fresh_table_dir(self.spark, "partition")), self._clause(value))
        self._release(value, old)

    def drop_partition(self, value: str) -> None:
        old = tables.location(self.spark, self.name, self._clause(value))
        tables.drop_partitions(self.spark, self.name, [self._clause(value)])
        self._release(value, old)

    def _release(self, value: str, folder: str) -> None:
        """Delete a folder that this partition showed, unless another name shows it."""
        own_folder = folder.startswith(tables.location(self.spark, self.name) + "/")
        ledger.disown(self.spark, folder, f"{self.name}/{self._clause(value)}")
        if own_folder or not ledger.owners(self.spark, folder):
            delete_dir(self.spark, folder)

    def _drop_all_of(self, values: list[str]) -> int:
        """Drop partitions in one statement, so that readers see all of them or none; then their files.

        A folder that cannot be deleted is left to :func:`ledger.vacuum`.
        """
        folders = {v: tables.location(self.spark, self.name, self._clause(v)) for v in values}
        tables.drop_partitions(self.spark, self.name, [self._clause(v) for v in values])
        self.spark.catalog.refreshTable(self.name)
        for v, folder in folders.items():
            try:
                self._release(v, folder)
            except Exception:
                log.exception("the files of partition %s of %s could not be deleted", v, self.name)
        return len(values)

    def retain_latest(self) -> int:
        """Drop every partition but the latest, the initial and the undated one."""
        keep = {self.latest(), INITIAL, UNDATED}
        return self._drop_all_of([v for v in self.values() if v not in keep])

    def drop_all(self) -> int:
        """Drop every partition but the initial and the undated one."""
        return self._drop_all_of([v for v in self.values() if v not in (INITIAL, UNDATED)])

    def rolling_replace(self, df: DataFrame) -> int:
        """Add new rows first and drop the older partitions only after that worked."""
        rows = self.append(df)
        self.retain_latest()
        return rows
