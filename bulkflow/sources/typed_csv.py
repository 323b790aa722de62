"""CSV files that declare their own table: row 1 names, row 2 types, data from row 3."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions.names import normalize_name, trim_space, trim_to_null
from bulkflow.functions.parse import Parsed, number_is_integer, number_value, parse_number, parse_number_as, parse_timestamp, read_as
from bulkflow.functions.times import whole_second
from bulkflow.functions.types import type_name
from bulkflow.session import delete_dir, fresh_table_dir
from bulkflow.sources.position import with_row_index
from bulkflow.sources.records import BAD, csv_options, first_file, leading_records


@dataclass
class TypedCsv:
    """A scan of one typed CSV file, or of a folder whose files are taken in path order.

    ``number_types`` fixes the Spark type of NUMBER columns by name; a cell that this type cannot
    hold is a bad cell.  A NUMBER column not named there becomes BIGINT when all its cells are
    64-bit integers and DOUBLE otherwise, which one aggregate over the whole file decides.
    """

    spark: SparkSession
    path: str
    sep: str = ","
    multi_line: bool = False
    number_types: dict[str, str] = field(default_factory=dict)
    timestamp_formats: list[str] | None = None

    @cached_property
    def _first_file(self) -> str:
        return first_file(self.spark, self.path)

    @cached_property
    def head(self) -> tuple[list[str], list[str]]:
        rows = leading_records(self.spark, self.path, 2, self.sep, trim=True)
        if len(rows) < 2:
            raise ValueError("a typed file begins with a row of names and a row of types")
        names, types = rows
        if len(types) < len(names):
            raise ValueError(f"{len(names)} names but only {len(types)} types")
        return names, types

    @cached_property
    def columns(self) -> list[tuple[str, str]]:
        """(name, declared type) per column."""
        out = []
        for i, (raw_name, raw_type) in enumerate(zip(*self.head)):
            name = normalize_name(raw_name)
            if not name:
                raise ValueError(f"column {i + 1} has no usable name: {raw_name!r}")
            out.append((name, type_name(raw_type, name)))
        names = [n for n, _ in out]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"several columns are called {repeated} once names are normalized")
        return out

    def _cells(self) -> DataFrame:
        """All records that are not blank, as trimmed text columns named by the header."""
        names = [n for n, _ in self.columns]
        schema = ", ".join(f"`{n}` string" for n in [*names, BAD])
        options = csv_options(self.sep, trim=True, multi_line=self.multi_line)
        scan = self.spark.read.options(**options).schema(schema).csv(self.path)
        columns = [F.col(n) for n in names]
        # Most records are decided by their first cell that is not empty.
        some = (trim_space(F.coalesce(*columns)) != "") | (trim_space(F.concat_ws("", *columns)) != "")
        # A record with extra cells is not blank when only the extra ones hold text.
        extra = F.regexp_replace(F.col(BAD), f'[\\s"{re.escape(self.sep)}]', "") != ""
        kept = scan.filter(F.coalesce(some, F.lit(False)) | extra)
        return kept.select(*[trim_to_null(c).alias(n) for n, c in zip(names, columns)])

    def _is_head(self, row: int) -> Column:
        """Whether a record of the first split reads like the given leading row."""
        cells = [raw.strip() or None for raw in self.head[row][: len(self.columns)]]
        cells += [None] * (len(self.columns) - len(cells))
        wanted = F.array(*[F.lit(c).cast("string") for c in cells])
        return F.array(*[F.col(n) for n, _ in self.columns]).eqNullSafe(wanted)

    def _leading(self) -> Column:
        """1 or 2 for a record of the first split that reads like the names or types row, else 0."""
        in_first_split = (F.col("_metadata.file_path") == self._first_file) & (
            F.col("_metadata.file_block_start") == 0
        )
        number = F.when(self._is_head(0), 1).when(self._is_head(1), 2)
        return F.coalesce(F.when(in_first_split, number), F.lit(0))

    @property
    def _head_is_unique(self) -> bool:
        """Whether the two leading rows could be told from data by their text alone."""
        return "by_text" in self.profile

    def numbered(self) -> DataFrame:
        """Text cells with ``_row``, the 1-based row number in the file (data starts at 3)."""
        rows = with_row_index(self._cells(), "_index")
        is_head = ((F.col("_index") == 0) & self._is_head(0)) | ((F.col("_index") == 1) & self._is_head(1))
        elsewhere = F.raise_error(F.lit("the first two rows in file order are not the names and the types")).cast("boolean")
        data = F.when(F.col("_index") > 1, True).when(is_head, False).otherwise(elsewhere)
        return rows.filter(data).withColumn("_row", F.col("_index") + 1).drop("_index")

    def text(self) -> DataFrame:
        """Text cells of the data rows.

        The two leading rows are cut off by their text when only they read like that in the
        first split; otherwise every row is numbered first.
        """
        if not self._head_is_unique:
            return self.numbered().drop("_row")
        return self._cells().filter(self._leading() == 0)

    @cached_property
    def _parsed(self) -> dict[str, Parsed]:
        """Value and error per column; built once, as every column costs driver time."""
        out = {}
        for name, kind in self.columns:
            c = F.col(name)
            if kind == "NUMBER" and name in self.number_types:
                out[name] = parse_number_as(self.number_types[name])(c)
            elif kind == "NUMBER":
                out[name] = parse_number(c)
            elif kind in ("DATE", "TIMESTAMP"):
                out[name] = parse_timestamp(self.timestamp_formats)(c)
            else:
                out[name] = Parsed(c, F.lit(None).cast("string"))
        return out

    def _measures(self) -> list[Column]:
        """Aggregates over cells with a ``_leading`` number: rows, bad cells, non-integral numbers."""
        errors = [parsed.error.isNotNull().cast("bigint") for parsed in self._parsed.values()]
        bad = _sum_of(errors)
        data = F.col("_leading") == 0
        measures = [
            F.count(F.when(data, 1)).alias("rows"),
            F.coalesce(F.sum(F.when(data, bad)), F.lit(0)).alias("bad"),
            F.count(F.when(F.col("_leading") == 1, 1)).alias("names_rows"),
            F.count(F.when(F.col("_leading") == 2, 1)).alias("types_rows"),
        ]
        for name in self._open_numbers():
            wide = data & F.col(name).isNotNull() & ~number_is_integer(F.col(name))
            measures.append(F.count(F.when(wide, 1)).alias(f"wide_{name}"))
        return measures

    def _flagged(self, by_text: bool) -> DataFrame:
        if by_text:
            return self._cells().withColumn("_leading", self._leading())
        return self.numbered().withColumn("_leading", F.lit(0))

    @cached_property
    def profile(self) -> dict[str, int]:
        """One pass: data rows, bad cells, and whether each open NUMBER column is integral."""
        found = self._flagged(by_text=True).agg(*self._measures()).first().asDict()
        if found["names_rows"] == found["types_rows"] == 1:
            return found | {"by_text": True}
        return self._flagged(by_text=False).agg(*self._measures()).first().asDict()

    def _open_numbers(self) -> list[str]:
        return [n for n, kind in self.columns if kind == "NUMBER" and n not in self.number_types]

    def _integral(self) -> set[str]:
        return {n for n in self._open_numbers() if not self.profile[f"wide_{n}"]}

    def _typed(self, integral: set[str]) -> list[Column]:
        out = []
        for name, kind in self.columns:
            parsed = self._parsed[name].value
            if name in integral:
                parsed = F.col(name).try_cast("bigint")  # every cell has been read as one by now
            elif kind == "DATE":
                parsed = whole_second(parsed)
            out.append(parsed.alias(name))
        return out

    def stage(self, row_number: bool = False) -> tuple[str, int]:
        """Typed rows written to a folder of their own: the folder and the row count.

        The types are decided by a pass over the whole file, the rows are converted once.  Bad
        cells raise before anything is written.
        """
        self.check()
        path = fresh_table_dir(self.spark, "typed")
        try:
            self.data(row_number=row_number).write.parquet(path)
        except Exception:
            delete_dir(self.spark, path)
            raise
        return path, self.profile["rows"]

    def rejects(self) -> DataFrame:
        """Every bad cell: ``row, col, column, raw, message`` (row and col count from 1)."""
        names = [n for n, _ in self.columns]
        # As columns, numbers are read once, however often a message refers to them.
        numbers, messages = {}, {}
        for i, (name, kind) in enumerate(self.columns):
            messages[f"_message_{i}"] = self._parsed[name].error
            if kind == "NUMBER" and name in self.number_types:
                forced, c, number, held = self.number_types[name], F.col(name), f"_number_{i}", f"_read_{i}"
                numbers |= {number: number_value(c), held: read_as(c, forced)}
                messages[f"_message_{i}"] = parse_number_as(forced)(c, F.col(number), F.col(held)).error
        # Messages are columns, too: inside a lambda every cell would be parsed by interpreted expressions.
        read = self.numbered().withColumns(numbers).withColumns(messages)
        found = F.array(
            *[
                F.struct(
                    F.lit(i + 1).cast("bigint").alias("col"),
                    F.lit(name).alias("column"),
                    F.col(name).alias("raw"),
                    F.col(f"_message_{i}").alias("message"),
                )
                for i, name in enumerate(names)
            ]
        )
        return read.select(F.col("_row").alias("row"), F.inline(found)).filter("message IS NOT NULL")

    def check(self) -> None:
        """Raise for the bad cell that comes first in the file."""
        if self.profile["bad"]:
            r = self.rejects().orderBy("row", "col").first()
            raise ValueError(f"row {r.row} col {r.col}: {r.message}")

    def data(self, strict: bool = True, row_number: bool = False) -> DataFrame:
        """Typed rows.  ``strict`` fails on the first bad cell, else bad cells are NULL."""
        if strict:
            self.check()
        source = self.numbered() if row_number else self.text()
        return source.select(*([F.col("_row")] if row_number else []), *self._typed(self._integral()))


def _sum_of(columns: list[Column]) -> Column:
    """Added up in pairs, so that the expression stays shallow however many columns there are."""
    while len(columns) > 1:
        columns = [a + b for a, b in zip(columns[::2], columns[1::2])] + columns[len(columns) - len(columns) % 2 :]
    return columns[0]
