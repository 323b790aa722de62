"""Merkle manifest of a dataset: one digest for all rows, one for each group, and a proof for each row.

Rows are leaves, in the order of their ids inside their group.  While a group has several nodes, runs
of ``arity`` consecutive ones become their parents; what remains is the group's subroot.  Subroots, in
the order of their groups, give the root in the same way.

Every level is one table of nodes (g, i).  It is joined with itself on computed sibling indices: i XOR
1 in binary trees, else the other slots of the run, one shifted join each; no group is ever gathered.
Rows in slot zero, with the siblings beside them, then emit the parents.  Proofs go the other way: a
node's path is its own siblings before its parent's path, so each level is joined with the next.

A leaf's position comes from range partitioning by (group, id) and the counts of (partition, group),
so a group may hold any share of the rows.

Defined results: a null value is ``-`` in its leaf; a null group is a group and comes first, and so do
null ids; a null id is never tampered with.  Rows with one id are ordered by their leaves, so equal
rows have equal leaves side by side and a proof each.  Texts of any length are digested whole.  An
empty table has no root and no proofs.  Columns that are not asked for are left behind before anything
else, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bulkflow.llm.components import written

#: Bits of a row number inside a partition, as Spark's increasing ids have them.
ROW_BITS = 33
#: The type of a path: the siblings before and behind, from the leaf's level upwards.
PATH = "array<struct<before: string, after: string>>"


class Manifest(NamedTuple):
    """``root``: the digest of everything, or None.  ``proofs``: (group, id, <also>, leaf, subroot, path)."""

    root: str | None
    proofs: DataFrame


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value: no two lists of values meet."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(*(field(v) for v in values))


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds (g, i, n), names ``df`` does not have: a number for the group in the order of groups, the row's index in it, the group's size.

    Materialises the rows in range partitions; the order should be total up to equal rows.
    """
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "positions")
    here = F.shiftright("at", ROW_BITS).alias("part")
    states = ranged.groupBy(here, *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    inside = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))  # one row per partition
    before = inside.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = states.select(
        F.col("part").alias("c_part"),
        *(F.col(c).alias(f"c_{c}") for c in group),
        F.min("first").over(inside).alias("g"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(inside).alias("n"),
    )
    on = F.shiftright("at", ROW_BITS) == F.col("c_part")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"c_{c}"))
    return ranged.join(carried, on).select(*df.columns, "g", (F.col("at") + F.col("shift")).alias("i"), "n")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, i, n, h, ...) of groups of several, with the siblings' digests in order: (before, after)."""
    several = nodes.where("n > 1")
    slot = F.col("i") % arity
    out = several
    for k in range(1, arity):
        sibling = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("i") - slot + (slot + k) % arity
        other = several.select(F.col("g").alias("sg"), F.col("i").alias("si"), F.col("h").alias(f"s{k}"))
        out = out.withColumn("sibling", sibling).join(other, (F.col("g") == F.col("sg")) & (F.col("sibling") == F.col("si")), "left").drop("sg", "si", "sibling")
    # Offset k is the slot k places on, so those behind come first and the slots before the node come last.
    offsets = [F.coalesce(f"s{k}", F.lit("")) for k in range(1, arity)]

    def joined(wanted) -> Column:
        return F.concat(*(F.when(wanted(k), s).otherwise("") for k, s in enumerate(offsets, 1)))

    behind = joined(lambda k: slot + k < arity)
    ahead = joined(lambda k: slot + k >= arity)
    return out.select(*nodes.columns, ahead.alias("before"), behind.alias("after"))


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above a level: rows in slot zero emit them."""
    zero = level.where(F.col("i") % arity == 0)
    return zero.select("g", (F.col("i") / arity).cast("long").alias("i"), F.ceil(F.col("n") / arity).alias("n"), digest(F.col("h"), F.col("after")).alias("h"))


class Tree(NamedTuple):
    """``levels``: the nodes of groups of several, with siblings.  ``tops``: (g, h, level) of what remains."""

    levels: list[DataFrame]
    tops: DataFrame | None


def grow(nodes: DataFrame, arity: int) -> Tree:
    """All levels above ``nodes`` (g, i, n, h, ...), each materialised."""
    size = nodes.agg(F.max("n")).first()[0]
    levels: list[DataFrame] = []
    tops = None
    while size:
        done = nodes.where("n = 1").select("g", "h", F.lit(len(levels)).alias("level"))
        tops = done if tops is None else tops.union(done)
        if size == 1:
            break
        levels.append(written(with_siblings(nodes, arity), "level"))
        nodes, size = parents(levels[-1], arity), -(-size // arity)
    return Tree(levels, None if tops is None else written(tops, "tops"))


def paths(tree: Tree, tops: DataFrame, arity: int, keep: list[str]) -> DataFrame:
    """(g, i, <keep>, subroot, path) of the leaves; ``tops`` (g, level, subroot, path) says how it goes on above."""
    found = None
    for at in range(len(tree.levels), -1, -1):
        roots = tops.where(F.col("level") == at).select("g", F.lit(0).cast("long").alias("i"), "subroot", "path")
        if at < len(tree.levels):
            above = found.select(F.col("g").alias("pg"), F.col("i").alias("pi"), "subroot", F.col("path").alias("above"))
            level = tree.levels[at].withColumn("run", (F.col("i") / arity).cast("long"))
            here = level.join(above, (F.col("g") == F.col("pg")) & (F.col("run") == F.col("pi")))
            own = F.array(F.struct("before", "after"))
            columns = [] if at else keep
            found = here.select("g", "i", *columns, "subroot", F.concat(own, "above").alias("path"))
        if at:
            # Written level by level: one join a job keeps plans small however tall the tree is.
            found = written(roots if found is None else found.union(roots), "paths")
    return found


def manifest(docs: DataFrame, values: Sequence[str], group_col: str, id_col: str, arity: int = 3, also: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs`` over the columns ``values``; ``also`` adds columns to the proofs."""
    if arity < 2:
        raise ValueError("a run needs two nodes or more")
    extra = also or {}
    leaves = docs.select(
        docs[group_col].alias("group"), docs[id_col].alias("id"), *(c.alias(f"x_{name}") for name, c in extra.items()), leaf_digest([docs[c] for c in values]).alias("h")
    )
    keep = ["group", "id", *(f"x_{name}" for name in extra)]
    nodes = written(positions(written(leaves, "leaves"), ["group"], ["id", "h"]), "nodes")
    tree = grow(nodes, arity)
    given = [F.col(f"x_{name}").alias(name) for name in extra]
    if tree.tops is None:
        nothing = nodes.select("group", "id", *given, F.col("h").alias("leaf"), F.col("h").alias("subroot"), F.array().cast(PATH).alias("path"))
        return Manifest(None, nothing)
    ranked = positions(tree.tops.select(F.col("g").alias("of"), "h", F.col("level").alias("height")), [], ["of"])
    subroots = written(ranked.select(F.lit(0).cast("long").alias("g"), "i", "n", "h", "of", "height"), "subroots")
    upper = grow(subroots, arity)
    root = upper.tops.first()["h"]
    ends = upper.tops.select("g", "level", F.col("h").alias("subroot"), F.array().cast(PATH).alias("path"))
    if upper.levels:
        ways = paths(upper, ends, arity, ["of", "height", "h"]).select("of", "height", "h", "path")
    else:
        ways = subroots.select("of", "height", "h", F.array().cast(PATH).alias("path"))
    tops = written(ways.select(F.col("of").alias("g"), F.col("height").alias("level"), F.col("h").alias("subroot"), "path"), "subroot-paths")
    lone = nodes.where("n = 1").join(tops, "g").select(*keep, F.col("h").alias("leaf"), "subroot", "path")
    if not tree.levels:
        found = lone
    else:
        found = paths(tree, tops, arity, [*keep, "h"]).select(*keep, F.col("h").alias("leaf"), "subroot", "path").union(lone)
    return Manifest(root, found.select("group", "id", *given, "leaf", "subroot", "path"))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf's level to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path's siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))
