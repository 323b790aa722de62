"""Upsert and keyed updates as join plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_null(df_keys: list[Column]) -> Column:
    out = F.lit(False)
    for c in df_keys:
        out = out | c.isNull()
    return out


def keep_last(source: DataFrame, keys: list[str], order: list[str] | None = None, distinct_order: bool = False) -> DataFrame:
    """One row per key, the last in ``order``; ``source`` has no NULL keys.

    ``distinct_order`` promises that no two rows have the same order, a single column of numbers or
    times: then the largest per key is a hash aggregate without sorting, and the rows are found by a
    join on key and order, in which no key is hot.

    The aggregate combines on the map side, so a key that holds most rows costs one row per
    task in the shuffle.  The keys come out as aggregates of their own: a later join then
    shuffles both its sides, and between two such shuffles adaptive execution can split a
    hot key of the other side.
    """
    order = order or []
    if distinct_order:
        (at,) = order
        newest = source.groupBy(*keys).agg(*[F.max(k).alias(f"_key_{k}") for k in keys], F.max(at).alias("_newest"))
        newest = newest.select(*[F.col(f"_key_{k}").alias(f"_k_{k}") for k in keys], "_newest")
        on = source[at] == F.col("_newest")
        for k in keys:
            on = on & (source[k] == F.col(f"_k_{k}"))
        return source.join(newest, on, "left_semi").drop(at)
    values = [c for c in source.columns if c not in keys and c not in order]
    same = [F.max(k).alias(f"_key_{k}") for k in keys]
    if not values:
        last = source.groupBy(*keys).agg(*same)
        return last.select(*[F.col(f"_key_{k}").alias(k) for k in keys])
    # Without an order any row of the key may stay, and the largest makes that repeatable.
    at = F.struct(*order) if order else F.struct(*values)
    last = source.groupBy(*keys).agg(*same, F.max_by(F.struct(*values), at).alias("_last"))
    return last.select(*[F.col(f"_key_{k}").alias(k) for k in keys], "_last.*")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    distinct_order: bool = False,
) -> DataFrame:
    """The target after applying the source rows one by one.

    * matched target rows (all of them, when the target repeats a key) take every non-key
      column of the last source row of that key; other target columns keep their values;
    * unmatched source rows are inserted, target columns the source lacks are NULL;
    * a NULL in a key matches nothing, so each such source row is inserted;
    * a source of key columns only inserts and never updates.

    ``order`` names source columns that give the order of application; they are not written.
    ``distinct_order`` says that it is one column without equal values, see :func:`keep_last`.
    """
    order = order or []
    if not keys:
        raise ValueError("key columns must not be empty")
    spelled = {c.lower(): c for c in target.columns}
    unknown = [c for c in source.columns if c not in order and c.lower() not in spelled]
    if unknown:
        raise ValueError(f"target has no columns {unknown}")
    source = source.select(*[F.col(c).alias(c if c in order else spelled[c.lower()]) for c in source.columns])
    missing = [k for k in keys if spelled.get(k.lower()) not in source.columns]
    if missing:
        raise ValueError(f"key columns not found in source: {missing}")
    keys = [spelled[k.lower()] for k in keys]
    written = [c for c in source.columns if c not in order]
    updated = [c for c in written if c not in keys]
    null_key = _any_null([F.col(k) for k in keys])
    # Rows with a NULL key match nothing: no shuffle for them, however many there are.
    anonymous = source.filter(null_key)
    last = keep_last(source.filter(~null_key), keys, order, distinct_order)
    # Both joins below use this one selection, so that the source is shuffled once.
    last = last.select(*[F.col(c).alias(f"_s_{c}") for c in written])

    def matches(side: DataFrame) -> Column:
        on = F.lit(True)
        for k in keys:
            on = on & (side[k] == F.col(f"_s_{k}"))
        return on

    kept = target
    if updated:
        # The target is on the side of the outer join that may be split when a key is hot.
        hit = F.col(f"_s_{keys[0]}").isNotNull()
        kept = target.join(last, matches(target), "left").select(
            *[
                F.when(hit, F.col(f"_s_{c}")).otherwise(target[c]).cast(target.schema[c].dataType).alias(c)
                if c in updated
                else target[c]
                for c in target.columns
            ]
        )
    # Distinct target keys: a repeated key is one row per task before the shuffle.
    present = target.select(*keys).filter(~null_key).distinct()
    fresh = last.join(present, matches(present), "left_anti")

    def shaped(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            *[
                (F.col(f"{prefix}{c}") if c in written else F.lit(None)).cast(target.schema[c].dataType).alias(c)
                for c in target.columns
            ]
        )

    return kept.unionByName(shaped(fresh, "_s_")).unionByName(shaped(anonymous, ""))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of key columns only."""
    return upsert(target, source.select(*keys), keys)


def update_all(table: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of every row, keeping the column types."""
    return table.withColumns({c: v.cast(table.schema[c].dataType) for c, v in values.items()})


def update_where(table: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows that satisfy the condition."""
    hit = F.coalesce(condition, F.lit(False))
    return table.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)).cast(table.schema[c].dataType) for c, v in values.items()}
    )


def last_write_wins(
    table: DataFrame,
    key: str,
    changes: DataFrame,
    change_key: str,
    column: str,
    value: str,
    order: list[str],
    columns: list[str],
) -> DataFrame:
    """Fold an ordered change log (change_key, column, value) and apply the last write per column.

    Writers of different columns of one row do not disturb each other.  A written NULL
    counts as a write.
    """
    at = F.struct(*order)
    folded = changes.filter(F.col(change_key).isNotNull()).groupBy(F.col(change_key).alias("_key")).agg(
        *[
            F.max_by(F.when(F.col(column) == c, F.struct(F.col(value).alias("v"))), F.when(F.col(column) == c, at)).alias(
                f"_w_{c}"
            )
            for c in columns
        ]
    )
    joined = table.join(folded, table[key] == F.col("_key"), "left")
    return joined.select(
        *[
            F.when(F.col(f"_w_{c}").isNotNull(), F.col(f"_w_{c}")["v"])
            .otherwise(table[c])
            .cast(table.schema[c].dataType)
            .alias(c)
            if c in columns
            else table[c]
            for c in table.columns
        ]
    )
