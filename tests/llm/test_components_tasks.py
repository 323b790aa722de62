from pyspark.sql import functions as F

from bulkflow.llm.components import TASK_ROWS, components, few_tasks


def test_rounds_over_few_edges_write_few_files(spark):
    """With many shuffle partitions every round wrote a file for each of them."""
    cores = spark.sparkContext.defaultParallelism
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        found = components(edges)
        assert {(r.node, r.root) for r in found.collect()} == {(n, 0) for n in range(41)}
        many = spark.range(10).repartition(61, "id")
        assert few_tasks(many, 10).rdd.getNumPartitions() == min(cores, 61)
        assert few_tasks(many, 61 * TASK_ROWS).rdd.getNumPartitions() == 61
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
