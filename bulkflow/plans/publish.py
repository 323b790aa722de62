"""Publishing complete snapshots: readers see the old rows until all new rows are there.

A published name is a view.  New rows are written to a folder (or table) nobody reads yet,
counted, and then the view is pointed there in one catalog call.  Readers that started
before keep the old files, which stay until they are pruned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.plans import ledger, tables
from bulkflow.plans.tables import LoadReport, Stopwatch
from bulkflow.session import children, delete_dir, quoted, sql_string, touch

VERSION = "bulkflow.version"
READERS = "_readers"
HISTORY = "bulkflow.history"


def _switch(spark: SparkSession, name: str, select: str, properties: dict[str, str]) -> None:
    props = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} TBLPROPERTIES ({props}) AS {select}")


@dataclass
class Snapshot:
    """A published name over immutable version folders.

    ``columns`` makes the snapshot a projection of what is loaded; ``keep`` is the number of
    versions whose files stay for readers that are still running.
    """

    spark: SparkSession
    name: str
    columns: list[str] | None = None
    keep: int = 2

    def path(self) -> str | None:
        """Folder of the version readers see now."""
        return tables.table_property(self.spark, self.name, VERSION)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def stage(self, df: DataFrame, max_rows_per_file: int = 0) -> tuple[str, int]:
        chosen = df.select(*self.columns) if self.columns else df
        return tables.write_fresh(chosen, self.name.replace(".", "_"), max_rows_per_file)

    def switch(self, path: str, rows: int, prune: bool = True) -> None:
        """Point readers at a staged folder after checking that it is complete."""
        staged = self.spark.read.parquet(path)
        found = staged.count()
        if found != rows:
            raise RuntimeError(f"staged version of {self.name} has {found} rows, expected {rows}")
        versions = [v for v in self._history() if v != path] + [path]
        self._point(staged, path, versions)
        if prune:
            self.prune()

    def adopt(self, path: str) -> None:
        """Point readers at files somebody else owns: no copy, and never deleted from here.

        A mark in the folder keeps its owner from pruning it while this name shows it.
        """
        before, staged = self.path(), self.spark.read.parquet(path)
        touch(self.spark, self._mark(path))
        self._point(staged, path, self._history())
        if before and before != path:
            delete_dir(self.spark, self._mark(before))

    def _mark(self, path: str) -> str:
        """Names that begin with an underscore are no data to Spark."""
        return f"{path}/{READERS}/{self.name}"

    def _history(self) -> list[str]:
        """Own version folders, oldest first."""
        return [v for v in (tables.table_property(self.spark, self.name, HISTORY) or "").split("\n") if v]

    def _point(self, staged: DataFrame, path: str, versions: list[str]) -> None:
        columns = ", ".join(quoted(c) for c in self.columns or staged.columns)
        select = f"SELECT {columns} FROM parquet.{quoted_path(path)}"
        before = self.path()
        ledger.own(self.spark, path, self.name)
        _switch(self.spark, self.name, select, {VERSION: path, HISTORY: "\n".join(versions)})
        if before not in versions:
            ledger.move(self.spark, before, path, self.name)

    def prune(self) -> None:
        """Delete the files of versions beyond the newest ``keep`` that no other name shows."""
        versions = self._history()
        old = [v for v in versions[: -self.keep] if not self._in_use(v)]
        kept = [v for v in versions if v not in old]
        if old:
            self.spark.sql(
                f"ALTER VIEW {quoted(self.name)} SET TBLPROPERTIES ({sql_string(HISTORY)} = {sql_string(chr(10).join(kept))})"
            )
        for v in old:
            ledger.disown(self.spark, v, self.name)
            delete_dir(self.spark, v)

    def _in_use(self, version: str) -> bool:
        """Whether another published name shows this version."""
        return bool(children(self.spark, f"{version}/{READERS}"))

    def publish(self, df: DataFrame) -> LoadReport:
        """Write a complete new version and switch to it; any failure leaves the old one."""
        watch = Stopwatch()
        path, rows = self.stage(df)
        written = watch.lap()
        self.switch(path, rows)
        return LoadReport(rows, written, watch.lap())


def quoted_path(path: str) -> str:
    return "`" + path.replace("`", "``") + "`"


@dataclass
class ABTable:
    """Two tables NAME_A and NAME_B behind one view NAME."""

    spark: SparkSession
    name: str

    def active(self) -> str | None:
        return tables.table_property(self.spark, self.name, VERSION)

    def inactive(self) -> str:
        return f"{self.name}_A" if self.active() != f"{self.name}_A" else f"{self.name}_B"

    def swap(self, df: DataFrame, drop_old: bool = False, on_count: Callable[[str, int], None] | None = None) -> LoadReport:
        """Load the table nobody reads, repoint the view, and empty the old table if asked.

        The rows go to a new folder that the table is pointed at; a reader that began before the
        last swap keeps its files until the swap after the next.
        """
        watch = Stopwatch()
        old, new = self.active(), self.inactive()
        path, rows = tables.write_fresh(df, new.replace(".", "_"))
        tables.create_over(self.spark, new, path)
        if on_count:
            on_count(new, rows)
        written = watch.lap()
        _switch(self.spark, self.name, f"SELECT * FROM {quoted(new)}", {VERSION: new})
        if drop_old and old:
            tables.truncate(self.spark, old)
        return LoadReport(rows, written, watch.lap())


class Source(Protocol):
    """What a full reload reads: checks first, then rows with a text column ``_error``."""

    def validate(self) -> None: ...

    def rows(self) -> DataFrame: ...


class Target(Protocol):
    """Where a full reload goes: rows are staged first, readers are switched last."""

    def stage(self, df: DataFrame, max_rows_per_file: int = 0) -> tuple[str, int]: ...

    def switch(self, path: str, rows: int, prune: bool = True) -> None: ...

    def prune(self) -> None: ...


class Published(Protocol):
    """A name that shows readers the files of a reloaded table."""

    def adopt(self, path: str) -> None: ...


DEFAULT_BATCH = 100


def batch_size(size: int) -> int:
    return size if size > 0 else DEFAULT_BATCH


def batch_plan(positions: DataFrame, position: str, size: int) -> DataFrame:
    """Rows per batch of a load: ``batch_no`` from 1, the last batch may be short."""
    number = (F.floor(F.col(position) / batch_size(size)) + 1).cast("bigint")
    return positions.groupBy(number.alias("batch_no")).agg(F.count(F.lit(1)).alias("rows"))


def full_reload(
    source: Source, table: Target, columns: list[str], published: Published | None = None, batch: int = 0
) -> LoadReport:
    """Replace all rows of ``table``, then refresh the snapshot ``published`` from it.

    Order of work, each failure stopping the rest: settings, source check, conversion and
    write, switch of the table, refresh.  With no ``published`` the refresh is skipped.
    The published name shares the table's immutable files instead of copying them; old files
    go only after it has moved on.  ``batch`` bounds the rows per written file (0: Spark's
    own choice).
    """
    if table is None:
        raise ValueError("no table to load was given")
    if not columns:
        raise ValueError("no columns to load were given")
    watch = Stopwatch()
    try:
        source.validate()
    except Exception as e:
        raise ValueError(f"the source did not pass its check: {e}") from e
    rows = source.rows()
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"the source has no columns {missing}")
    good = rows.select(*columns)
    if "_error" in rows.columns:
        # One pass: the first bad row fails the write, and nothing staged becomes visible.
        failed = F.raise_error(F.concat(F.lit("a row could not be converted: "), F.col("_error"))).cast("boolean")
        good = rows.filter(F.when(F.col("_error").isNotNull(), failed).otherwise(True)).select(*columns)
    path, count = table.stage(good, batch)
    written = watch.lap()
    table.switch(path, count, prune=False)
    switched, refreshed = watch.lap(), 0.0
    if published is not None:
        published.adopt(path)
        refreshed = watch.lap()
    table.prune()
    return LoadReport(count, written, switched + refreshed, refreshed)
