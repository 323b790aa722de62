"""Reading CSV records whose number of fields may vary."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BAD = "_bad_record"


def csv_options(sep: str = ",", trim: bool = False, multi_line: bool = False, header: bool = False) -> dict:
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "emptyValue": "",
        "header": header,
        "multiLine": multi_line,
        "ignoreLeadingWhiteSpace": trim,
        "ignoreTrailingWhiteSpace": trim,
        "recursiveFileLookup": True,
        "columnNameOfCorruptRecord": BAD,
        # The field-count check needs the whole record, so the reader must not drop columns.
        "columnPruning": False,
        "maxCharsPerColumn": -1,
    }


#: Stands behind the last field of a record while it is read, so that missing fields and empty ones differ.
_END = "\u0003end\u0003"


def fields_of(record: Column, width: int, sep: str = ",") -> Column:
    """Fields of one CSV record as an array of text, read by Spark's own CSV reader.

    ``width`` is the most fields that a record can have, see :func:`width_of`; records may have fewer.
    """
    names = [f"c{i}" for i in range(width + 1)]
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "maxColumns": str(width + 2), "maxCharsPerColumn": "-1"}
    read = F.from_csv(F.concat(record, F.lit(sep + _END)), ", ".join(f"{n} string" for n in names), options)

    def cut(r: Column) -> Column:
        cells = F.array(*[F.coalesce(r[n], F.lit("")) for n in names])
        return F.slice(cells, F.lit(1), F.array_position(cells, _END).cast("int") - 1)

    # Through a lambda, so that a record is read once however many of its fields are used.
    return F.element_at(F.transform(F.array(read), cut), 1)


def width_of(records: DataFrame, column: str, sep: str = ",") -> int:
    """An upper bound of the number of fields of any record, by one aggregate.

    Separators inside quoted fields do not count, so long texts do not make the records wide.  In a record
    with a quote outside of well-formed quoted fields all separators count.
    """
    text, s = F.col(column), re.escape(sep)
    # Possessive, so that any number of doubled quotes needs no stack.  What is cut out begins where a field
    # does: no quote is left before it, or else one stays in the rest.
    rest = F.regexp_replace(text, rf'(^|{s})"[^"]*+(?:""[^"]*+)*+"(?={s}|\z)', "$1")
    bare = F.when(F.contains(text, F.lit('"')), F.when(F.contains(rest, F.lit('"')), text).otherwise(rest)).otherwise(text)
    # Through a lambda, so that a record is cut once.
    seps = F.element_at(F.transform(F.array(bare), lambda x: F.length(x) - F.length(F.replace(x, F.lit(sep), F.lit("")))), 1) / len(sep)
    # A count beside it: Spark does not read a file for its unparsed records alone.
    others = [F.count(F.col(c)) for c in records.columns if c != column][:1]
    return int(records.agg(F.coalesce(F.max(seps), F.lit(0)), *others).first()[0]) + 1


def field_count(fields: Column) -> Column:
    return F.size(fields)


def field_value(fields: Column, index: int) -> Column:
    """Text of a field, '' when the record has no such field."""
    if index < 0:
        return F.lit("")
    return F.coalesce(F.get(fields, F.lit(index)), F.lit(""))


def raw_records(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False, width: int | None = None
) -> tuple[DataFrame, Column]:
    """A scan with one row per record, and the expression that gives the record's fields.

    Empty lines are no records.  The most fields of a record are found by an aggregate, unless ``width``
    says so.  Records that hold line breaks inside quotes need ``multi_line`` and the usual ``width`` of a
    record; such files cannot be split over tasks.
    """
    if not multi_line:
        lines = lines_of(spark, path)
        return lines, fields_of(F.col("value"), width or width_of(lines, "value", sep), sep)
    if not width:
        raise ValueError("multi_line records need a width")
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in [*names, BAD])
    scan = spark.read.options(**csv_options(sep, multi_line=True)).schema(schema).csv(path)
    whole = F.array(*[F.coalesce(F.col(n), F.lit("")) for n in names])
    most = max(width, width_of(scan, BAD, sep))
    return scan, F.when(F.col(BAD).isNull(), whole).otherwise(fields_of(F.col(BAD), most, sep))


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """The lines that are not empty, as ``value``."""
    return spark.read.option("recursiveFileLookup", True).text(path).filter(F.col("value") != "")


def read_records(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False, width: int | None = None
) -> DataFrame:
    """One row per record with an array column ``fields``."""
    scan, fields = raw_records(spark, path, sep, multi_line, width)
    return scan.select(fields.alias("fields"))


def first_file(spark: SparkSession, path: str) -> str:
    files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    if not files:
        raise FileNotFoundError(f"no file below {path}")
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    uri = spark._jvm.java.net.URI
    # Spelled the way the scan's own file_path column spells it (file:/x, not file:///x).
    # The first by decoded path: the order in which rows are numbered, too (position.file_order).
    return path_of(path_of(uri(min(files, key=lambda f: (unquote(f), f)))).toString()).toUri().toString()


def leading_records(spark: SparkSession, path: str, n: int, sep: str = ",", trim: bool = False) -> list[list[str]]:
    """The first ``n`` records of the first file; ``n`` is one or two header lines.

    ``trim`` trims the fields and skips records whose fields are all blank.
    """
    lines = lines_of(spark, path).filter(F.col("_metadata.file_path") == first_file(spark, path))
    if trim:
        lines = lines.filter(F.regexp_replace("value", f'[\\s"{re.escape(sep)}]', "") != "")
    tagged = lines.select("value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"))
    # The first split lies in one partition, in file order, so the scan stops after n records.
    found = tagged.filter(F.col("_block") == 0).limit(n).collect()
    if len(found) < n:
        # The first split holds fewer records than that: the splits, or the file, are tiny.
        found = tagged.orderBy("_block", "_mid").limit(n).collect()
    if not found:
        return []
    width = max(r.value.count(sep) for r in found) + 1
    heads = spark.createDataFrame([(i, r.value.strip() if trim else r.value) for i, r in enumerate(found)], "i int, value string")
    record = F.regexp_replace("value", rf'({re.escape(sep)})[ \t]+"', '$1"') if trim else F.col("value")
    rows = heads.select("i", fields_of(record, width, sep).alias("fields")).collect()
    return [[f.strip() if trim else f for f in r.fields] for r in sorted(rows, key=lambda r: r.i)]
