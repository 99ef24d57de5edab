"""A Merkle manifest of a data set: a digest per row, trees of digests, one root, and a proof per row.

The rows of a group (``tree``) are the leaves of its tree, in the order of a key. While a tree has several
nodes, every ``ARITY`` consecutive ones (the last may be fewer, even one) become their digest. The roots of
the trees, in the order of the groups, are the leaves of one more tree, whose root stands for all.

Every level is a self-join: each node sends its digest to the computed indices of its siblings (its slot
shifted by one to seven, within its run of eight), where the equijoin meets it, and then the nodes in slot
zero emit the parents. A level is stored before the next one is built, an eighth as large, so levels grow
with the logarithm of the rows and a lost executor costs a re-read. Keys are (tree, index), so a group with
most of the rows is spread like any other. Going down again, each level joins the siblings of its parents:
a row's path holds, level by level, the digests left and right of it.

Leaves are numbered without a task that sees a whole group: rows are dealt by ranges of (tree, key), and
what the earlier ranges hold of the same tree is added to the place within the range. Rows with equal keys
go by their digest; rows that are equal in both are interchangeable, each is a leaf of its own, and they are
spread by a number of their row.

A null group comes first and is a tree like others; a null key comes first in its tree. Null values in a row
are part of its digest (``-``), apart from empty ones (``0:``). An empty table has no trees and no root. Extra
columns of any name are carried along unless asked for in the digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pubweave.llm.common import column, columns, fresh, store

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
_NODE = ["tree", "idx"]


def digest(*parts: Column | str) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows read alike; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return digest(*map(field, values))


@dataclass
class Manifest:
    """``proofs``: the given rows with their ``subroot`` and ``path``, an array of (left, right) from the leaf
    up to the root. ``root`` is null for an empty table."""

    proofs: DataFrame
    root: str | None


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of (tree, key, digest, row) with ``idx``, their number in their tree, and ``total``, the size
    of the tree. The second value is the size of the largest tree."""
    order = ["tree", F.col("key").asc_nulls_first(), "digest", "salt"]
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(*order).sortWithinPartitions(*order)
    at = dealt.select("tree", "digest", "row", F.monotonically_increasing_id().alias("at"))
    placed = store(at.withColumn("part", F.shiftright("at", 33)), "leaves").table
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    ranges = store(offsets, "ranges")
    largest = ranges.table.agg(F.max("total")).first()[0] or 0
    joined = placed.join(ranges.joinable(), ["tree", "part"])
    idx = (F.col("at") + F.col("shift")).alias("idx")
    return joined.select("tree", idx, "total", "digest", "row"), largest


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, idx, total, digest, row) with the digests ``left`` and ``right`` of them in their run."""
    slot = F.col("idx") % ARITY
    shifts = F.explode(F.sequence(F.lit(1), F.lit(ARITY - 1))).alias("shift")
    shifted = nodes.select("tree", "idx", "total", "digest", shifts)
    target = F.col("idx") - slot + (slot + F.col("shift")) % ARITY
    sibling = F.struct(slot.alias("slot"), F.col("digest").alias("digest")).alias("sibling")
    sent = shifted.where(target < F.col("total")).select("tree", target.alias("idx"), sibling)
    met = nodes.join(sent, _NODE, "left").groupBy(*_NODE).agg(
        *(F.first(c).alias(c) for c in ("total", "digest", "row")),
        F.sort_array(F.collect_list("sibling")).alias("siblings"),
    )

    def side(chosen) -> Column:
        return F.array_join(F.transform(F.filter("siblings", chosen), lambda s: s["digest"]), "")

    left, right = side(lambda s: s["slot"] < slot), side(lambda s: s["slot"] > slot)
    return met.select(*_NODE, "total", "digest", "row", left.alias("left"), right.alias("right"))


def parents(level: DataFrame) -> DataFrame:
    """The parents of a level, from the nodes in slot zero."""
    total = F.floor((F.col("total") + (ARITY - 1)) / ARITY).cast("long")
    return level.where(F.col("idx") % ARITY == 0).select(
        "tree",
        F.floor(F.col("idx") / ARITY).cast("long").alias("idx"),
        total.alias("total"),
        digest("digest", "right").alias("digest"),
        F.lit(None).cast(level.schema["row"].dataType).alias("row"),
    )


@dataclass
class Level:
    """``nodes`` of all trees that reach this level, and those with siblings, stored (``paired``)."""

    nodes: DataFrame
    paired: DataFrame | None

    @property
    def tops(self) -> DataFrame:
        return self.nodes.where("total = 1")


def climb(rows: DataFrame) -> list[Level]:
    """The levels over rows of (tree, key, digest, row), leaves first."""
    nodes, largest = numbered(rows)
    levels: list[Level] = []
    while largest > 1:
        paired = store(with_siblings(nodes.where("total > 1")), "level").table
        levels.append(Level(nodes, paired))
        nodes, largest = parents(paired), -(-largest // ARITY)
    return [*levels, Level(nodes, None)]


def descend(levels: Sequence[Level], crown: DataFrame | None = None) -> DataFrame:
    """``tree``, ``row``, ``top`` (the root of the tree) and ``path`` of each leaf; ``crown`` has the path from each
    ``tree``'s root on (``rest``), if it goes on."""
    below: DataFrame | None = None
    for level in reversed(levels):
        tops = level.tops.select(*_NODE, "row", F.col("digest").alias("top"), F.array().cast(PATH).alias("path"))
        if crown is not None:
            tops = tops.drop("path").join(crown.select("tree", F.col("rest").alias("path")), "tree")
        if level.paired is not None:
            up = below.select("tree", F.col("idx").alias("parent"), "top", F.col("path").alias("rest"))
            own = level.paired.withColumn("parent", F.floor(F.col("idx") / ARITY).cast("long"))
            path = F.concat(F.array(F.struct("left", "right")).cast(PATH), "rest").alias("path")
            tops = own.join(up, ["tree", "parent"]).select(*_NODE, "row", "top", path).unionByName(tops)
        below = tops
    return below.select("tree", "row", "top", "path")


def build(rows: DataFrame, leaf: str, tree: str, key: str) -> Manifest:
    """The manifest of rows whose digests are in the column ``leaf``, grouped by ``tree`` and ordered by
    ``key``."""
    name = F.coalesce(F.concat(F.lit("="), column(tree).cast("string")), F.lit("-"))
    levels = climb(
        rows.select(
            name.alias("tree"),
            column(key).alias("key"),
            column(leaf).alias("digest"),
            F.struct(*columns(rows)).alias("row"),
        )
    )
    roots = None
    for level in levels:
        tops = level.tops.select(
            F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.col("tree").alias("row")
        )
        roots = tops if roots is None else roots.unionByName(tops)
    over = descend(climb(store(roots, "subroots").table))
    crown = store(over.select(F.col("row").alias("tree"), "top", F.col("path").alias("rest")), "crown").table
    root = crown.first()
    subroot, path = fresh(rows, "subroot"), fresh(rows, "path")
    proofs = descend(levels, crown).select("row.*", F.col("top").alias(subroot), F.col("path").alias(path))
    return Manifest(proofs, root and root["top"])


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda held, p: digest(p["left"], held, p["right"]))
