"""Order-dependent computations (previous value, running sum) that hold up under skew.

A plain window gathers each group in one task, which fails when one group holds a large
part of the data.  Here the rows are range-partitioned by (group, order), so a large group
spreads over many partitions; each partition works on its own part, and a table with one
row per (partition, group) carries the state from one partition to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bulkflow.session import cut_lineage

SEGMENT = "_seg"


def segmented(df: DataFrame, group: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by (group, order), number the partitions, and materialise.

    The order must be total inside a group (end it with a unique column).
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return cut_lineage(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def _join_carry(seg: DataFrame, states: DataFrame, group: list[str]) -> DataFrame:
    """Equi-join on (segment, group), so a large group stays spread; NULL group values meet."""
    carried = states.select(*[F.col(c).alias(f"_c_{c}") for c in [SEGMENT, *group]], "_carry")
    on = F.col(SEGMENT) == F.col(f"_c_{SEGMENT}")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_c_{g}"))
    return seg.join(carried, on, "left")


def with_previous(seg: DataFrame, group: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """Add the values of the previous row of the group; ``columns`` maps source to new name."""
    inside = Window.partitionBy(SEGMENT, *group).orderBy(*order)
    here = seg.withColumn("_inside", F.lag(F.struct(*columns)).over(inside))
    states = seg.groupBy(SEGMENT, *group).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(*group).orderBy(SEGMENT))
    joined = _join_carry(here, states.withColumn("_carry", before).filter(F.col("_carry").isNotNull()), group)
    out = joined.withColumn("_previous", F.coalesce("_inside", "_carry"))
    return out.select(*seg.columns, *[F.col("_previous")[source].alias(new) for source, new in columns.items()])


def with_running_sum(
    seg: DataFrame, group: list[str], order: list[str], value: str, name: str, total: str | None = None
) -> DataFrame:
    """Add the sum of ``value`` up to and including each row of the group, and the group's total."""
    inside = Window.partitionBy(SEGMENT, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = seg.withColumn("_inside", F.sum(value).over(inside))
    states = seg.groupBy(SEGMENT, *group).agg(F.sum(value).alias("_sum"))
    across = Window.partitionBy(*group).orderBy(SEGMENT)
    before = F.coalesce(F.sum("_sum").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("_sum").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    joined = _join_carry(here, states.withColumn("_carry", F.struct(before.alias("before"), whole.alias("whole"))), group)
    added = [(F.col("_inside") + F.col("_carry.before")).alias(name)]
    if total:
        added.append(F.col("_carry.whole").alias(total))
    return joined.select(*seg.columns, *added)
