"""CSV records with line breaks inside quotes, read in many tasks however large a file is.

A line begins a record when an even number of quotes stands before it in its file.  Every split counts
its own quotes; the parity of the splits before it (one row per split) tells each split in which state
it begins.  So records are put together inside their splits, and only what crosses a border, at most one
piece per split, is joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bulkflow.session import cut_lineage
from bulkflow.sources.position import file_order
from bulkflow.sources.records import fields_of, width_of


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``row_index, record``: the records of all files, in the order of their paths; empty lines are no records.

    A quoted line break comes back as one line feed.  Quotes that are not part of a quoted field must be
    doubled; a quote that is never closed makes the rest of its file one record.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    lines = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    lines = cut_lineage(lines)  # the numbers of the lines must be the same below
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    carried = splits.select(F.col("file").alias("c_file"), F.col("block").alias("c_block"), F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("carry"))
    here = lines.join(carried, (F.col("file") == F.col("c_file")) & (F.col("block") == F.col("c_block")))
    inside = Window.partitionBy("file", "block").orderBy("at")
    opened = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("carry")
    # An empty line between records is none; one inside quotes belongs to its record.
    marked = here.withColumn("begins", (opened % 2 == 0).cast("int")).filter("begins = 0 or value <> ''")
    numbered = marked.withColumn("record", F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # One piece per record and split; the record 0 of a split goes on from a split before it.
    ordered = F.array_sort(F.collect_list(F.struct("at", "value")))
    pieces = numbered.groupBy("file", "block", "record").agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("text"))
    pieces = cut_lineage(pieces)
    own = pieces.groupBy("file", "block").agg(F.max("record").alias("records"))
    last = F.last(F.when(F.col("records") > 0, F.struct("block", "records")), ignorenulls=True).over(before)
    placed = own.select("file", "block", "records", last.alias("open"))
    rest = pieces.filter("record = 0").join(placed, ["file", "block"])
    rest = rest.groupBy(F.col("file").alias("r_file"), F.col("open.block").alias("r_block"), F.col("open.records").alias("r_record")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("rest")
    )
    whole = pieces.filter("record > 0").join(
        rest, (F.col("file") == F.col("r_file")) & (F.col("block") == F.col("r_block")) & (F.col("record") == F.col("r_record")), "left"
    )
    # One row per split from here on: file metadata, not data.
    in_order = Window.orderBy(file_order(F.col("file")), "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select(F.col("file").alias("o_file"), F.col("block").alias("o_block"), F.coalesce(F.sum("records").over(in_order), F.lit(0)).alias("offset"))
    indexed = whole.join(offsets, (F.col("file") == F.col("o_file")) & (F.col("block") == F.col("o_block")))
    return indexed.select((F.col("offset") + F.col("record") - 1).alias("row_index"), F.concat_ws("\n", "text", "rest").alias("record"))


def read_quoted(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``row_index, fields`` of the records of :func:`quoted_records`."""
    records = cut_lineage(quoted_records(spark, path))
    return records.select("row_index", fields_of(F.col("record"), width_of(records.select("record"), "record", sep), sep).alias("fields"))


# -- reading a part of a file again and again ----------------------------------------------


def store_records(records: DataFrame, path: str, index: str = "row_index", rows_per_file: int = 0) -> None:
    """Numbered records as files with narrow ranges of numbers, so that a part can be read without the rest."""
    laid = records.repartitionByRange(index).sortWithinPartitions(index)
    laid.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def stored_chunk(spark: SparkSession, path: str, number: int, size: int, index: str = "row_index") -> DataFrame:
    """The records of one chunk; the range is pushed down, so other files show only their statistics."""
    stored = spark.read.parquet(path)
    if size <= 0:
        return stored if number == 0 else stored.limit(0)
    return stored.filter(F.col(index).between(number * size, (number + 1) * size - 1))
