"""Comparing the members of groups without a task for a whole group.

A group of n members is dealt by hash into blocks of bounded size, and each pair of blocks is a tile: one
unit of work, of bounded size too. A member travels once to each tile of its block, so a group costs n
rows times its number of blocks, not n squared rows, and tiles of a hot group spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TILE = ["tile_row", "tile_column"]


def tiled(members: DataFrame, blocks: Column, by: str) -> DataFrame:
    """Adds ``block`` and a row for each tile (``tile_row`` <= ``tile_column``) of the member's block;
    ``blocks`` is how many blocks its group has, ``by`` the member's id."""
    dealt = members.withColumn("blocks", blocks.cast("int")).withColumn(
        "block", F.pmod(F.xxhash64(by), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = dealt.withColumn("other", other)
    return spread.withColumns(
        {"tile_row": F.least("block", "other"), "tile_column": F.greatest("block", "other")}
    ).drop("other", "blocks")


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from sorted batches, with the bounds of the groups. All keys are integers."""
    rest: pa.Table | None = None

    def bounds(table: pa.Table) -> np.ndarray:
        values = np.stack([table.column(k).to_numpy() for k in keys])
        change = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1
        return np.concatenate([[0], change, [table.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        edges = bounds(table)
        rest = table.slice(edges[-2])
        if len(edges) > 2:
            yield table.slice(0, edges[-2]), edges[:-1]
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def in_tiles(
    members: DataFrame,
    keys: list[str],
    work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``work`` on the tables of whole tiles; ``keys`` name the group."""
    order = [*keys, *TILE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, order):
            yield from work(table, edges)

    return members.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


class Forest:
    """Union-find over 0..n-1; the root is the least member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
