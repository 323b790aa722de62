"""CSV files made of a header record, body records and a tail record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.sources.position import chunk_of, with_row_index
from bulkflow.sources.records import lines_of, raw_records


def read_sections(
    spark: SparkSession,
    path: str,
    has_header: bool = False,
    has_tail: bool = False,
    sep: str = ",",
    multi_line: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Columns ``row_index, role, body_index, fields``; role is header, body or tail.

    A single record with both flags is the header; with only the tail flag it is the tail.
    """
    # Fields are split after numbering, so reports that need few records split few.
    records, fields = raw_records(spark, path, sep, multi_line, width)
    rows = with_row_index(records, "row_index", total="_total")
    is_header = (F.col("row_index") == 0) & F.lit(has_header)
    is_tail = (F.col("row_index") == F.col("_total") - 1) & F.lit(has_tail) & ~is_header
    role = F.when(is_header, "header").when(is_tail, "tail").otherwise("body")
    body_index = F.when(role == "body", F.col("row_index") - F.lit(1 if has_header else 0))
    return rows.select("row_index", role.alias("role"), body_index.alias("body_index"), fields.alias("fields"))


def body(sections: DataFrame) -> DataFrame:
    return sections.filter(F.col("role") == "body").select("body_index", "fields")


def body_count(spark: SparkSession, path: str, has_header: bool = False, has_tail: bool = False) -> DataFrame:
    """Number of body records of a file, by one count over its lines."""
    n = F.count(F.lit(1))
    header = F.when(n > 0, 1).otherwise(0) if has_header else F.lit(0)
    tail = F.when(n > header, 1).otherwise(0) if has_tail else F.lit(0)
    return lines_of(spark, path).agg((n - header - tail).cast("bigint").alias("body_rows"))


def count_body(sections: DataFrame) -> DataFrame:
    return sections.agg(F.count(F.when(F.col("role") == "body", 1)).alias("body_rows"))


def assign_chunks(sections: DataFrame, size: int) -> DataFrame:
    """Body records with their chunk number and whether that chunk is the last one."""
    rows = body(sections)
    last = rows.agg(F.max("body_index")).scalar()
    chunk = chunk_of(F.col("body_index"), size)
    return rows.withColumn("chunk_id", chunk).withColumn("ended", chunk_of(last, size) == F.col("chunk_id"))


def read_chunk(sections: DataFrame, number: int, size: int) -> DataFrame:
    """The records of one chunk."""
    return assign_chunks(sections, size).filter(F.col("chunk_id") == number)


def validation_report(
    sections: DataFrame,
    header: dict[int, str] | None = None,
    header_count: int | None = None,
    tail: dict[int, str] | None = None,
    tail_count: int | None = None,
    body_not_empty: bool = False,
) -> DataFrame:
    """One row per asked check: ``check, expected, actual, ok``.

    ``actual`` is NULL when the record or the field does not exist.
    """
    one = sections.agg(
        F.max(F.when(F.col("role") == "header", F.col("fields"))).alias("header"),
        F.max(F.when(F.col("role") == "tail", F.col("fields"))).alias("tail"),
        F.count(F.when(F.col("role") == "body", 1)).alias("body_rows"),
    )

    def check(name: str, expected: str, actual, ok=None):
        good = actual == expected if ok is None else ok
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(expected).alias("expected"),
            actual.cast("string").alias("actual"),
            F.coalesce(good, F.lit(False)).alias("ok"),
        )

    checks = []
    for record, values, count in (("header", header, header_count), ("tail", tail, tail_count)):
        if count is not None:
            checks.append(check(f"{record} count", str(count), F.size(F.col(record)).cast("string")))
        for i, text in (values or {}).items():
            found = F.get(F.col(record), F.lit(i)) if i >= 0 else F.lit(None).cast("string")
            checks.append(check(f"{record}[{i}]", text, found))
    if body_not_empty:
        checks.append(check("body rows", "> 0", F.col("body_rows"), F.col("body_rows") > 0))
    if not checks:
        raise ValueError("no check asked for")
    return one.select(F.inline(F.array(*checks)))


def enforce(report: DataFrame) -> None:
    """Raise when any check of a validation report failed."""
    failed = [f"{r['check']}: expected {r['expected']!r}, got {r['actual']!r}" for r in report.filter(~F.col("ok")).collect()]
    if failed:
        raise ValueError("file validation failed: " + "; ".join(failed))
