"""Shared by the query modules: reading tables, writing CSV inputs, and the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries by function name, with their SQL where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_columns(df: DataFrame) -> DataFrame:
    """All columns as text; times keep their microseconds."""
    return df.select(*[df[c].cast("string").alias(c) for c in df.columns])


def sectioned_csv(df: DataFrame, label: str, head: list[str], tail: list[str] = (), sep: str = ",") -> str:
    """One CSV data set as a folder: head lines, body rows in the order of ``df``, tail lines.

    Files are read in the order of their paths, so the sections follow each other; the names sort
    otherwise as URLs have them.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    for folder, lines in (("0 head", head), ("0~tail", tail)):
        if lines:
            spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(f"{path}/{folder}")
    text_columns(df).write.options(sep=sep, escape='"', emptyValue="").csv(f"{path}/0!body")
    return path


def typed_csv(df: DataFrame, types: list[str], label: str) -> str:
    """A typed CSV data set: names, types, data."""
    return sectioned_csv(df, label, [",".join(df.columns), ",".join(types)])


def ragged_csv(spark: SparkSession, sf_dir: str) -> str:
    """A CSV file with a record per page: its id, then as many fields as its address has parts, some of them quoted."""
    path = fresh_dir(spark, "pages")
    quoted = F.transform(F.split("url", "/"), lambda x: F.when(x.rlike('[",]|^[a-m]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
    table(spark, sf_dir, "pages").select(F.concat_ws(",", F.col("page_id").cast("string"), F.array_join(quoted, ","))).write.text(path)
    return path


def lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
