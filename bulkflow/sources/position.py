"""Global row numbers for a distributed file scan.

Line numbers, tail detection and last-row-wins need the position of a record in the file.
No global sort or single-task window over the records is used: every file split counts its
own records, the (small) table of split counts becomes running offsets, and each record adds
its rank inside its split to the offset of the split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def file_order(path: Column) -> Column:
    """What files are ordered by: their decoded path, as :func:`bulkflow.sources.records.first_file` has it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_row_index(scan: DataFrame, index: str = "row_index", total: str | None = None) -> DataFrame:
    """Add the 0-based position of every record, files taken in path order.

    ``scan`` must be a file scan, optionally with filters and projections, and nothing that
    moves rows.  ``total`` names an optional column holding the record count.
    """
    tagged = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ).withColumn("_mid", F.monotonically_increasing_id())

    splits = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first")
    )
    # One row per split from here on: file metadata (input bytes / split size), not data.
    in_order = Window.orderBy(file_order(F.col("_file")), "_file", "_block")
    offsets = splits.select(
        "*",
        F.coalesce(F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    # How to join is left to adaptive execution, which knows the real size of the offsets.
    rank = F.col("_mid") - F.col("_first")
    in_split = (rank >= 0) & (rank < F.col("_rows"))
    position = F.when(in_split, F.col("_offset") + rank).otherwise(
        F.raise_error(F.lit("file splits changed while rows were being numbered")).cast("bigint")
    )
    added = [position.alias(index)]
    if total is not None:
        added.append(F.col("_all").alias(total))
    return tagged.join(offsets, ["_file", "_block"]).select(*scan.columns, *added)


def chunk_of(position: Column, size: int) -> Column:
    """0-based chunk of a 0-based position; a size of 0 or less means one single chunk."""
    if size <= 0:
        return F.lit(0).cast("bigint")
    return F.floor(position / F.lit(size)).cast("bigint")
