"""CSV files read through a mapping: header name -> target column with a parser."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions.parse import Parsed, Parser, no_error, parse_string
from bulkflow.sources.position import with_row_index
from bulkflow.sources.records import BAD, csv_options, leading_records


@dataclass(frozen=True)
class Mapping:
    """``header`` '' means the column does not come from the file (its parser gets '')."""

    header: str
    target: str
    parser: Parser | None = None


@dataclass
class MappedCsv:
    """Every file starts with a header record and every record has the header's field count."""

    spark: SparkSession
    path: str
    mappings: list[Mapping]
    sep: str = ","
    header_count: int = 0
    multi_line: bool = False

    @cached_property
    def header(self) -> list[str]:
        rows = leading_records(self.spark, self.path, 1, self.sep)
        if not rows:
            raise ValueError(f"{self.path} has no header record")
        return rows[0]

    def validate(self) -> None:
        if not self.mappings:
            raise ValueError("no column mappings were given")
        for i, m in enumerate(self.mappings):
            if not m.target:
                raise ValueError(f"mapping {i + 1} names no target column")
        if self.header_count > 0 and len(self.header) != self.header_count:
            raise ValueError(f"the header has {len(self.header)} fields instead of {self.header_count}")
        for m in self.mappings:
            if m.header and m.header not in self.header:
                raise ValueError(f"the file has no field named {m.header!r}")

    def _scan(self) -> DataFrame:
        names = [f"c{i}" for i in range(len(self.header))]
        schema = ", ".join(f"{n} string" for n in [*names, BAD])
        options = csv_options(self.sep, multi_line=self.multi_line, header=True)
        return self.spark.read.options(**options).schema(schema).csv(self.path)

    def _parsed(self) -> list[tuple[Mapping, Parsed]]:
        # A repeated header name means its last position.
        position = {name: i for i, name in enumerate(self.header)}
        out = []
        for m in self.mappings:
            raw = F.coalesce(F.col(f"c{position[m.header]}"), F.lit("")) if m.header else F.lit("")
            out.append((m, (m.parser or parse_string)(raw)))
        return out

    def rows(self) -> DataFrame:
        """Target columns plus ``_error``: the first problem of the record, NULL when good."""
        self.validate()
        parsed = self._parsed()
        width = F.when(F.col(BAD).isNotNull(), F.lit("wrong number of fields"))
        errors = [
            F.concat(F.lit(f"field {m.header!r} for {m.target!r}: "), p.error) for m, p in parsed
        ]
        values = [p.value.alias(m.target) for m, p in parsed]
        return self._scan().select(*values, F.coalesce(width, *errors, no_error()).alias("_error"))

    def data(self, strict: bool = True) -> DataFrame:
        """Typed rows; ``strict`` raises for the first bad record, else bad records are left out."""
        rows = self.rows()
        if strict:
            self.check()
        return rows.filter(F.col("_error").isNull()).drop("_error")

    def rejects(self) -> DataFrame:
        """``row_index`` (0-based data record) and message of every bad record."""
        rows = with_row_index(self.rows(), "row_index")
        return rows.filter(F.col("_error").isNotNull()).select("row_index", F.col("_error").alias("message"))

    def check(self) -> None:
        if self.rows().filter(F.col("_error").isNotNull()).isEmpty():
            return
        r = self.rejects().orderBy("row_index").first()
        raise ValueError(f"row {r.row_index + 1}: {r.message}")
