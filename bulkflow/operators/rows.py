"""Row-shape operators: trimming, blank rows, ragged rows, mapping by name, batch typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.functions.names import trim_to_null


def trim_skip_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trim text cells, turn empty cells into NULL, drop rows where all of them are empty."""
    trimmed = df.withColumns({c: trim_to_null(F.col(c)) for c in columns})
    return trimmed.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def align(fields: Column, names: list[str]) -> list[Column]:
    """Columns of a record with a varying field count: short ones end in NULL, extras are ignored."""
    return [F.nullif(F.get(fields, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]


def width_error(fields: Column, expected: int) -> Column:
    """NULL when the record has the expected number of values."""
    n = F.size(fields)
    return F.when(n != expected, F.concat(F.lit(f"expected {expected} values, got "), n.cast("string")))


def map_columns(df: DataFrame, columns: list[str], tag: str = "db") -> DataFrame:
    """Pick source columns for target columns: metadata tag first, then name ignoring case."""
    picked = []
    for target in columns:
        by_tag = [f.name for f in df.schema.fields if f.metadata.get(tag) == target]
        by_name = [f.name for f in df.schema.fields if f.name.lower() == target.lower()]
        found = by_tag or by_name
        if not found:
            raise ValueError(f"column {target!r} not found among those of the rows")
        picked.append(F.col(f"`{found[0]}`").alias(target))
    return df.select(*picked)


# What a cell's own type counts as, and the Spark type it is bound with.
KINDS = {
    "BIGINT": "integer",
    "DOUBLE": "float",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "time",
    "TIMESTAMP_NTZ": "time",
    "DATE": "time",
    "STRING": "text",
}
BOUND = {"integer": "bigint", "float": "double", "boolean": "boolean", "time": "timestamp_ntz", "text": "string"}


def cell_kind(c: Column) -> Column:
    """Kind of a VARIANT cell: integer, float, boolean, time, text, generic; NULL when empty."""
    name = F.schema_of_variant(c)
    kind = F.when(name.startswith("DECIMAL"), "float")
    for type_name, k in KINDS.items():
        kind = kind.when(name == type_name, k)
    return F.when(c.isNotNull() & (name != "VOID"), kind.otherwise("generic"))


def batch_kinds(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """One row per column: the kind of its first non-null cell, and the first cell that breaks it.

    A cell breaks the kind when it is of another kind or NULL.  A column whose first cell is
    generic, or that is all NULL, takes anything.
    """
    at = F.struct(*order)
    cells = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), cell_kind(F.col(c)).alias("kind")) for c in columns])),
        at.alias("_at"),
    )
    firsts = cells.groupBy("column", "kind").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_cells"))
    # From here at most seven rows per column.
    sample = F.min_by(F.col("kind"), F.when(F.col("kind").isNotNull(), F.col("_first")))
    per_column = firsts.groupBy("column").agg(
        sample.alias("kind"), F.collect_list(F.struct("kind", "_first", "_cells")).alias("_seen")
    )
    typed = F.coalesce(F.col("kind") != "generic", F.lit(False))
    broken = F.filter("_seen", lambda x: F.lit(True) & ~x["kind"].eqNullSafe(F.col("kind")))
    breaks = F.aggregate(broken, F.lit(0).cast("bigint"), lambda a, x: a + x["_cells"])
    first = F.array_min(F.transform(broken, lambda x: x["_first"]))
    return per_column.select(
        "column",
        F.coalesce(F.col("kind"), F.lit("generic")).alias("kind"),
        F.when(typed, breaks).otherwise(F.lit(0)).cast("bigint").alias("mismatches"),
        F.when(typed, first).alias("first_mismatch"),
    )


class MixedColumn(ValueError):
    """A column of a batch holds cells of several kinds; ``row`` has the order values of the first odd one."""

    def __init__(self, column: str, kind: str, row: tuple) -> None:
        super().__init__(f"column {column} holds something else than {kind}, first in row {row}")
        self.column, self.kind, self.row = column, kind, row


def bind_batch(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Typed columns for a batch of VARIANT cells; raises :class:`MixedColumn` for the first column that is mixed."""
    kinds = {r["column"]: r for r in batch_kinds(df, columns, order).collect()}
    for c in columns:
        r = kinds.get(c)
        if r is not None and r["mismatches"]:
            raise MixedColumn(c, r["kind"], tuple(r["first_mismatch"]))
    return df.withColumns(
        {
            c: F.try_variant_get(F.col(c), "$", BOUND[kinds[c]["kind"]])
            for c in columns
            if c in kinds and kinds[c]["kind"] in BOUND
        }
    )
