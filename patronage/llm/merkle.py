"""Merkle manifest of a table: leaves per group, a tree per group, one tree over the groups' roots, and proofs of every row.

H is the lower-case hex SHA-256 of its inputs joined. A leaf is H of the columns given, each ``-`` if NULL, else its UTF-8 byte
count, ``:`` and its value. Leaves of a group ascend by id; while a group has several nodes, every ``arity`` consecutive ones (the
last run: fewer, even one) become their H. What remains is the group's subroot; subroots, ordered by group, give the root likewise.

Each level is one table of (group, place, digest). A node meets its siblings in equijoins on computed places: XOR 1 for pairs,
slot offsets otherwise. The rows of slot zero emit the parents. Paths then go down, one join a level with half the rows of
the level below, so a proof is put together once per node and not once per row and level. Places come from a range shuffle, and joins
are on (group, place): a group with a third of all rows is spread like any other. Levels are stored, which cuts the lineage.

Edge cases: a NULL group is the first one; NULL ids come first in their group; rows of equal id ascend by leaf, so repeated rows
take neighbouring places; NULL and empty texts differ (``-`` and ``0:``); extra columns are not read; an empty table has no root and gives
no rows; a table of one row has its leaf as root and an empty proof.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import group_positions
from ..session import materialize

def digest(*parts: Column) -> Column:
    """H of binary digests, each read as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(*parts))), 256))


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]), 256))


def placed(nodes: DataFrame, by: str | None, order: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``nodes`` with ``place`` from 0 inside each ``by`` group, from a range shuffle."""
    one = nodes if by else nodes.withColumn("all", F.lit(0))
    rows = group_positions(one, [by or "all"], order, key)
    return rows.select(*nodes.columns, (F.col("row") - 1).alias("place"))


@dataclass(frozen=True)
class Tree:
    """Stored levels from the leaves up; each has (grp, place, digest, before, after) and what the leaves carry at level 0."""

    levels: list[DataFrame]
    arity: int

    @staticmethod
    def lone() -> Column:
        """The only node of its group at its level."""
        return (F.col("place") == 0) & (F.octet_length("after") == 0)

    @staticmethod
    def build(nodes: DataFrame, arity: int = 2) -> Tree:
        """``nodes`` has grp (not NULL), place and digest, and any columns to carry at level 0."""
        last, height = nodes.agg(F.max("place")).first()[0] or 0, 0
        while arity ** height <= last:
            height += 1
        levels = []
        for level in range(height + 1):
            linked = materialize(with_siblings(nodes, arity), f"merkle-{level}")
            levels.append(linked)
            nodes = linked.where((F.col("place") % arity == 0) & ~Tree.lone()).select(
                "grp", F.floor(F.col("place") / arity).alias("place"), digest(F.col("digest"), F.col("after")).alias("digest"))
        return Tree(levels, arity)

    def roots(self) -> DataFrame:
        """(grp, digest) of the last node of every group."""
        found = [level.where(self.lone()).select("grp", "digest") for level in self.levels]
        total = found[0]
        for more in found[1:]:
            total = total.unionByName(more)
        return total

    def paths(self, above: DataFrame) -> DataFrame:
        """Level 0 with ``path``, the siblings (before, after) from the leaf up, then what ``above`` (grp, path, carried
        columns) has for the group."""
        carried = [c for c in above.columns if c not in ("grp", "path")]
        found = None
        for number, level in reversed(list(enumerate(self.levels))):
            own = level.columns if number == 0 else ["grp", "place"]
            rows = level.where(self.lone()).join(above, "grp").select(*own, "path", *carried)
            if found is not None:
                parents = found.withColumnRenamed("place", "up").withColumnRenamed("path", "rest")
                inner = level.where(~self.lone()).withColumn("up", F.floor(F.col("place") / self.arity)).join(parents, ["grp", "up"])
                path = F.concat(F.array(F.struct("before", "after")), F.col("rest"))
                rows = rows.unionByName(inner.withColumn("path", path).select(*own, "path", *carried))
            found = materialize(rows, f"merkle-path-{number}") if number else rows
        return found


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of the run's lower slots joined in ``before`` and of its higher slots in ``after``."""
    slot, nothing = F.col("place") % arity, F.lit(b"")
    others = nodes.select(F.col("grp").alias("g"), F.col("place").alias("p"), F.col("digest").alias("d"))
    joined, before, after = nodes, [], []
    for offset in range(1, arity):
        sibling = (F.col("place").bitwiseXOR(F.lit(1).cast("long")) if arity == 2
                   else F.col("place") - slot + (slot + offset) % arity)
        name = f"sibling_{offset}"
        joined = (joined.withColumn("at", sibling).join(others, (F.col("grp") == F.col("g")) & (F.col("at") == F.col("p")), "left")
                  .withColumnRenamed("d", name).drop("g", "p", "at"))
        wraps, found = slot >= arity - offset, F.coalesce(name, nothing)
        before.append(F.when(wraps, found).otherwise(nothing))
        after.append(F.when(wraps, nothing).otherwise(found))
    return joined.select(*nodes.columns, F.concat(*before).alias("before"), F.concat(*after).alias("after"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def proof(path: Column) -> Column:
    """All siblings of a path as one binary, level by level, left to right."""
    return F.aggregate(path, F.lit(b""), lambda found, step: F.concat(found, step["before"], step["after"]))


def manifest(docs: DataFrame, columns: Sequence[str], key: str = "doc_id", group: str = "lang", carry: dict[str, Column] | None = None,
             arity: int = 2) -> DataFrame:
    """One row per row of ``docs``: the key, ``leaf``, ``subroot``, ``root``, ``path`` (all binary digests) and the columns of ``carry``.

    ``columns`` go into the leaf in their order. ``carry`` are narrow expressions over ``docs`` that come along to the result.
    """
    carry = carry or {}
    taken = {"grp", "digest", "place", "no_key", "sort_key", "leaf", "subroot", "root", "path"} & {c.lower() for c in (key, *carry)}
    if taken:
        raise ValueError(f"names of the result: {sorted(taken)}")
    rows = docs.select(F.col(key).alias("id"), *[value.alias(name) for name, value in carry.items()],
                       leaf([F.col(c) for c in columns]).alias("digest"),
                       F.concat(F.when(F.col(group).isNull(), "0").otherwise("1"), F.coalesce(F.col(group).cast("string"), F.lit(""))).alias("grp"))
    known = F.col("id").isNotNull().cast("int").alias("known")
    empty = F.coalesce("id", F.lit("" if dict(docs.dtypes)[key] == "string" else 0).cast(dict(docs.dtypes)[key])).alias("sort_key")
    leaves = materialize(placed(rows.select("*", known, empty), "grp", ["known", "sort_key"], ["digest"]).drop("known", "sort_key"), "merkle-leaves")
    inner = Tree.build(leaves, arity)
    subroots = materialize(inner.roots(), "merkle-subroots")
    outer = Tree.build(placed(subroots.select(F.col("grp").alias("name"), "digest", F.lit("").alias("grp")), None, ["name"], []), arity)
    top = outer.roots().select("grp", F.array().cast("array<struct<before:binary,after:binary>>").alias("path"), F.col("digest").alias("root"))
    above = outer.paths(top).select(F.col("name").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    found = inner.paths(materialize(above, "merkle-above"))
    return found.select(F.col("id").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path", *carry)

