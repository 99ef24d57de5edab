"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points, in order. Reference points (pivots) are vectors of
the table, taken by hash order, as many as twice the square root of the table's size: so the inverted
list of a pivot, the vectors that have it among their nearest, grows with the square root too. Of pivots
that are close to each other only the first stays (``apart``): otherwise a dense group would bring pivots
of its own in proportion to its size, and its members would each be nearest to other ones. So a dense
group shares one list, which grows with the group, as do the links that are counted in it. Vectors
that share at least ``Settings.shared`` of their nearest pivots are candidates, counted in the list of
the least pivot they share, and verified there by their cosine in double precision. Lists are compared
in tiles of bounded size (``tiles``); with fewer pivots than ``Settings.shared``, sharing all of them is
enough. A tile returns for each vector how many it has linked, and the
links as a forest.

Equal vectors are one point with a weight, so a hot vector costs one row. Vectors that are null, empty,
zero, or hold null or non-finite components are linked with nothing, and so are vectors of different
lengths. Rows with one ``vec_id`` and equal vectors count once; rows without a ``vec_id`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from pubweave.llm.common import ship, store
from pubweave.llm.components import components
from pubweave.llm.tiles import Forest, in_tiles, tiled


@dataclass(frozen=True)
class Settings:
    """``pivots``: the bound of the fitted sample, whatever the input. ``nearest`` pivots describe a
    vector, ``shared`` of them make a candidate. No two pivots have a cosine above ``apart``."""

    cosine: float = 0.9
    pivots: int = 16_384
    nearest: int = 10
    shared: int = 2
    apart: float = 0.6
    tile_rows: int = 1000


def usable(vector: Column) -> Column:
    """The vector as ``array<double>``, null if it can't be compared; no negative zeros."""
    numbers = F.transform(vector.cast("array<double>"), lambda x: x + F.lit(0.0))
    whole = F.forall(
        numbers,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    nonzero = F.exists(numbers, lambda x: x != 0)
    return F.when(F.coalesce(whole & nonzero, F.lit(False)), numbers)


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def described(points: DataFrame, pivots: Broadcast, settings: Settings) -> DataFrame:
    """(point, copies, vector, pivots): the numbers of the nearest pivots, nearest first. Pivots of
    another length don't count."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                first, known = pivots.value[size]
                near = np.argsort(
                    -(unit(matrix(part.column("vector"))) @ known.T), axis=1, kind="stable"
                )[:, : settings.nearest]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]),
                    pa.array((near + first).ravel().astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("point"), part.column("copies"), part.column("vector"), lists],
                    ["point", "copies", "vector", "pivots"],
                )

    return points.mapInArrow(
        describe, "point long, copies long, vector array<double>, pivots array<int>"
    )


def thinned(known: np.ndarray, most: float) -> np.ndarray:
    """Unit vectors in their order, without those of a cosine above ``most`` to one that stays."""
    stay = known[:0]
    for start in range(0, len(known), 256):
        part = known[start : start + 256]
        part = part[(part @ stay.T).max(1, initial=-1.0) <= most]
        close = part @ part.T > most
        own: list[int] = []
        for k in range(len(part)):
            if not close[k, own].any():
                own.append(k)
        stay = np.concatenate([stay, part[own]])
    return stay


def pick_pivots(points: DataFrame, settings: Settings) -> dict[int, tuple[int, np.ndarray]]:
    """Unit vectors by length, with the number of the first; each length has its own."""
    counts = {
        r["size"]: r["count"] for r in points.groupBy(F.size("vector").alias("size")).count().collect()
    }
    picked: dict[int, tuple[int, np.ndarray]] = {}
    first = 0
    for size, count in sorted(counts.items()):
        wanted = min(settings.pivots, max(2 * settings.nearest, ceil(2 * sqrt(count))))
        rows = (
            points.where(F.size("vector") == size)
            .orderBy(F.xxhash64("point"), "point")
            .limit(wanted)
            .select("vector")
            .toArrow()
        )
        known = thinned(unit(matrix(rows.column("vector").combine_chunks())), settings.apart)
        picked[size] = (first, known)
        first += len(known)
    return picked


def bitmaps(pivots: list[np.ndarray], words: int) -> np.ndarray:
    """A bit for each pivot, in 64-bit words: (rows, words)."""
    made = np.zeros((len(pivots), words), np.uint64)
    for k, own in enumerate(pivots):
        np.bitwise_or.at(made[k], own >> 6, np.uint64(1) << (own & 63).astype(np.uint64))
    return made


def compare(tiles: DataFrame, settings: Settings) -> DataFrame:
    """(point, links, root) for each linked point of each tile: how many vectors it links to, and the
    least point that the tile's links lead to."""

    def work(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = table.combine_chunks().to_batches()[0]
        points, copies = rows.column("point").to_numpy(), rows.column("copies").to_numpy()
        pivot, block = rows.column("pivot").to_numpy(), rows.column("block").to_numpy()
        low, high = rows.column("tile_row").to_numpy(), rows.column("tile_column").to_numpy()
        out: list[tuple[int, int, int]] = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = rows.slice(a, b - a)
            lists = own.column("pivots")
            numbers = lists.flatten().to_numpy().reshape(b - a, -1)
            known, local = np.unique(numbers, return_inverse=True)
            bits = bitmaps(list(local.reshape(numbers.shape)), (len(known) + 63) // 64)
            here = int(np.searchsorted(known, pivot[a]))
            vectors = unit(matrix(own.column("vector")))
            left = np.flatnonzero(block[a:b] == low[a])
            right = np.flatnonzero(block[a:b] == high[a])
            shape = (len(left), len(right))
            count, below = np.zeros(shape, np.int16), np.zeros(shape, bool)
            for word in range(bits.shape[1]):
                both = bits[left, word][:, None] & bits[right, word][None, :]
                count += np.bitwise_count(both)
                if word * 64 < here:
                    mask = (1 << min(64, here - word * 64)) - 1
                    below |= (both & np.uint64(mask)) != 0
            chosen = (count >= min(settings.shared, numbers.shape[1])) & ~below
            if low[a] == high[a]:
                chosen = np.triu(chosen, 1)
            chosen &= vectors[left] @ vectors[right].T >= settings.cosine
            links = np.zeros(b - a, np.int64)
            links[left] += chosen @ copies[a:b][right]
            links[right] += copies[a:b][left] @ chosen
            forest = Forest(b - a)
            order = np.argsort(points[a:b], kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(b - a)
            owner = rank[right]  # a point already joined with the one of the column
            for k in np.flatnonzero(chosen.any(1)).tolist():
                i, own_columns = int(rank[left[k]]), np.flatnonzero(chosen[k])
                for j in np.unique(owner[own_columns]).tolist():
                    forest.join(i, j)
                owner[own_columns] = i
            for k in np.flatnonzero(links).tolist():
                root = order[forest.root(int(rank[k]))]
                out.append((int(points[a + k]), int(links[k]), int(points[a + root])))
        yield pa.record_batch(
            {
                name: pa.array([o[k] for o in out], pa.int64())
                for k, name in enumerate(("point", "links", "root"))
            }
        )

    return in_tiles(tiles, ["pivot"], work, "point long, links long, root long")


def near_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row per ``vec_id``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = store(
        vectors.where("vec_id is not null")
        .select(F.col("vec_id").cast("long").alias("vec_id"), usable(F.col("embedding")).alias("vector"))
        .distinct(),
        "vectors",
    ).table
    points = store(
        rows.where("vector is not null")
        .groupBy("vector")
        .agg(F.min("vec_id").alias("point"), F.count("*").alias("copies"))
        .select("point", "copies", "vector"),
        "points",
    ).table
    pivots = spark.sparkContext.broadcast(pick_pivots(points, settings))
    index = described(points, pivots, settings)
    index = store(index, "index").table
    listed = index.withColumn("pivot", F.explode("pivots"))
    # At most one row a pivot, and pivots are bounded.
    sizes = index.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(F.count("*").alias("n"))
    members = listed.join(F.broadcast(sizes), "pivot")
    tiles = tiled(members, F.ceil(F.col("n") / settings.tile_rows), "point").drop("n")
    linked = store(compare(tiles, settings), "links").table
    degree = linked.groupBy("point").agg(F.sum("links").alias("links"))
    found = components(
        linked.select(F.col("point").alias("a"), F.col("root").alias("b"))
    )
    copies = rows.join(points, "vector").select("vec_id", "point", "copies")
    own = (
        copies.join(degree, "point", "left")
        .join(found, F.col("point") == F.col("node"), "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "point").alias("component"),
        )
        .groupBy("vec_id")
        .agg(F.max("links").alias("links"), F.min("component").alias("component"))
    )
    ids = rows.select("vec_id").distinct()
    component = F.coalesce("component", "vec_id")
    return ids.join(own, "vec_id", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
