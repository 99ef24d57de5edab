"""Connected components by alternating stars.

Each round first points the larger neighbours of every node to its least neighbour, then every node's
smaller neighbours to the least of them, until nothing changes; what is left are stars around the least
node of each component. Rounds grow with the logarithm of the input. Each round is a table in the shared
folder, so a lost executor costs a re-read; a hot node is a hot join key, which adaptive execution splits,
and minima are combined before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pubweave.llm.common import store
from pubweave.storage import discard


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    pointed = both.where("b > a").join(least, "a")
    return pointed.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of ``edges`` (a, b). A component bears the name of its least node, which has no
    row itself. Edges with a null end, and from a node to itself, count for nothing."""
    spark = edges.sparkSession

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = store(edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    seen = state(now.table)
    while True:
        after = store(_small_star(_large_star(now.table)), "edges")
        discard(spark, now.path)
        now, before, seen = after, seen, state(after.table)
        if before == seen:
            return now.table.select(F.col("a").alias("node"), F.col("b").alias("component"))
