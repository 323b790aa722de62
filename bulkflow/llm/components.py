"""Connected components of an edge table, as repeated joins and aggregates.

Each round sends every node's larger neighbours to the smallest node around (large star), then
the smaller ones and the node itself (small star).  Trees become stars in a number of rounds
that grows with the logarithm of the component, and no node's neighbours are ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulkflow.session import fresh_dir, scratch_root


#: Rows for which a further task, and so a further file of a checkpoint, is worth while.
TASK_ROWS = 50_000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, in no more tasks than those need or the cores can take at once.

    A checkpoint writes a file per task, and a local folder starts a process for each file's permissions.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS))


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: lost executors do not matter any more."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Unlike a checkpoint it is known by its real size afterwards.  A checkpoint keeps the estimate of the
    plan before it, and that of a join is a product: over a dozen joins of joins it has millions of digits.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """For ``edges`` (a, b): one row (node, root) per node, with the smallest node of its component.

    Loops and repeated edges do no harm; an empty table has no rows.
    """
    now = durable(edges.select("a", "b").where("a <> b").distinct())
    mark = _mark(now)
    while True:
        now = durable(few_tasks(_small_star(_large_star(now)), mark[0]))
        before, mark = mark, _mark(now)
        if before == mark:
            break
    stars = now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())
