"""Incremental file ingest: new files are checked, appended to a table and published once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.functions.parse import Parser, first_error
from bulkflow.plans.publish import Snapshot
from bulkflow.session import children, fresh_dir, make_dir, rename
from bulkflow.sources.records import BAD, csv_options


def read_csv_stream(
    spark: SparkSession, path: str, header: list[str], sep: str = ",", max_files: int | None = None
) -> DataFrame:
    """Text columns of the CSV files arriving in a folder; each file starts with the header.

    A record with fewer or more fields than the header keeps its text in the last column, and
    :func:`convert` makes an error of it.
    """
    options = csv_options(sep, header=True)
    schema = ", ".join(f"`{h}` string" for h in [*header, BAD])
    reader = spark.readStream.options(**options).option("enforceSchema", False).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def convert(df: DataFrame, parsers: dict[str, Parser]) -> DataFrame:
    """Typed columns plus ``_error``: a wrong number of fields first, then the first bad field."""
    parsed = {c: p(F.coalesce(F.col(c), F.lit(""))) for c, p in parsers.items()}
    error = first_error(list(parsed.items()))
    if BAD in df.columns:
        ragged = F.concat(F.lit("wrong number of fields in '"), F.col(BAD), F.lit("'"))
        error = F.coalesce(F.when(F.col(BAD).isNotNull(), ragged), error)
    return df.select(*[p.value.alias(c) for c, p in parsed.items()], error.alias("_error"))


def ingest(
    stream: DataFrame,
    parsers: dict[str, Parser],
    staging: str,
    checkpoint: str,
    snapshot: Snapshot,
) -> int:
    """Process all files that are there now, then publish everything ingested so far.

    Each micro-batch goes to its own folder in a hidden inbox below ``staging``, overwritten
    when the batch is tried again, so a restart neither loses nor doubles rows.  Any bad row
    fails the run before anything is published.  At the end the whole inbox becomes one run
    among the published ones by a single rename, so the published name always shows one parent
    folder, however many batches there were.  Without any file it shows no rows.  Gives the
    number of rows readers see.
    """
    spark = stream.sparkSession
    converted = convert(stream, parsers)
    inbox, published = f"{staging}/_inbox", f"{staging}/published"

    def write_batch(batch: DataFrame, number: int) -> None:
        failed = F.raise_error(F.concat(F.lit("a row could not be converted: "), F.col("_error"))).cast("boolean")
        good = batch.filter(F.when(F.col("_error").isNotNull(), failed).otherwise(True)).drop("_error")
        good.write.mode("overwrite").parquet(f"{inbox}/batch={number}")

    query = (
        converted.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    columns = converted.drop("_error")
    if not children(spark, published):
        # An empty file with the columns, so that the name can be read before the first rows.
        first = fresh_dir(spark, "first")
        spark.createDataFrame([], columns.schema).write.parquet(f"{first}/batch=-1")
        rename(spark, first, f"{published}/run=0")
    batches = [int(d.rsplit("=", 1)[1]) for d in children(spark, inbox)]
    if batches:
        rename(spark, inbox, f"{published}/run={min(batches) + 1}")
    make_dir(spark, staging)
    snapshot.columns = snapshot.columns or columns.columns
    snapshot.adopt(published)
    return snapshot.read().count()


def for_each_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Run a batch function over everything a stream holds now."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
