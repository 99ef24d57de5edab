"""Rounds of ``author_pagerank`` over vectors instead of rows.

Papers and authors lie in as many blocks as there are tasks. A block of papers numbers its own authors, and holds
its memberships as arrays of these numbers. The home of an author holds their rank. A round has two shuffles: a
home sends each block of papers one vector, of the shares of those of its authors that the block has, and the block
sends back one vector of what they receive. Which place of a vector is whose is settled once, before the rounds.

So a round moves eight bytes per author and block, not a row per membership, and an author of very many papers is
sent once to a block like any other. The sums are numpy's; the functions are made here, by value, so that executors
need not have this package installed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pubweave.storage import discard, shuffle_partitions, store, store_bucketed

#: Memberships of a block: some 12 bytes each in a round, some 60 while the block is made.
BLOCK = 8_000_000
#: Memberships in a row of a block.
PIECE = 1_000_000

_PAPERS = "block bigint, peer bigint, ids binary, members binary, counts binary, weights binary"
_HOMES = "block bigint, peer bigint, ids binary, degrees binary, places binary"
_VECTORS = "block bigint, peer bigint, vector binary"


def block_numbers(spark: SparkSession, memberships: int) -> list[int]:
    """A number for each block: the least whose hash leads to its bucket, so that every task gets one block.
    There are as many blocks as tasks at a time, or a multiple."""
    cores = spark.sparkContext.defaultParallelism
    count = cores * max(1, -(-memberships // (BLOCK * cores)))
    bucket = F.pmod(F.hash("id"), F.lit(count)).alias("bucket")
    found = spark.range(64 * count).groupBy(bucket).agg(F.min("id").alias("id"))
    return sorted(row.id for row in found.collect())


def block_of(number: Column, blocks: list[int]) -> Column:
    every = F.array(*(F.lit(b).cast("bigint") for b in blocks))
    return F.element_at(every, (F.pmod(number, F.lit(len(blocks))) + 1).cast("int"))


def rounds_in_blocks(
    memberships: DataFrame,
    authors: DataFrame,
    reset: float,
    max_iter: int,
    blocks: list[int],
    rounds_per_job: int,
) -> DataFrame:
    """``(id, rank)`` after ``max_iter`` rounds, one at least, from ranks of 1, all of them run. Ranks are written every
    ``rounds_per_job`` rounds.

    ``memberships`` has ``(block, paper, papers, id)``, the rows of a paper in one block; ``authors`` has
    ``(id, outdegree)`` of all their authors.
    """
    spark, count = memberships.sparkSession, len(blocks)
    steps = _steps(blocks, reset, PIECE)
    dealt = memberships.select("block", "paper", "papers", "id").repartition(count, "block")
    papers = store_bucketed(dealt.mapInArrow(steps["pack"], _PAPERS), "block", count)
    wanted = papers.table.filter("ids is not null").select(
        F.col("peer").alias("block"), F.col("block").alias("peer"), "ids"
    )
    at_home = authors.select(block_of(F.col("id"), blocks).alias("block"), "id", F.col("outdegree").cast("double"))

    def meet(left: DataFrame, right: DataFrame, step: str, schema: str) -> DataFrame:
        return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(steps[step], schema)

    with shuffle_partitions(spark, count):
        homes = store_bucketed(meet(at_home, wanted, "settle", _HOMES), "block", count)
        sums = papers.table.filter("members is not null").select("block", "members", "counts", "weights")
        places = homes.table.select("block", "peer", "degrees", "places")
        nothing = places.select("block", "peer", F.col("degrees").alias("vector")).limit(0)
        ranks, superseded = nothing, []
        for first in range(0, max_iter, rounds_per_job):
            met = ranks
            for _ in range(first, min(first + rounds_per_job, max_iter)):
                met = meet(sums, meet(places, met, "send", _VECTORS), "add", _VECTORS)
            stored = store(meet(places, met, "rank", _VECTORS), "ranks")
            for path in superseded:
                discard(spark, path)
            ranks, superseded = stored.table, [stored.path]
        names = homes.table.filter("ids is not null").select("block", "ids")
        result = store(meet(names, ranks, "unpack", "id bigint, rank double"), "ranks").table
    for path in superseded:
        discard(spark, path)
    papers.discard()
    homes.discard()
    return result


def _steps(blocks: list[int], reset: float, piece: int) -> dict:
    """The functions of the tasks, by name."""
    numbers = np.array(blocks, dtype="int64")

    def column(table, name):
        return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)

    def arrays(table, name, kind):
        """The arrays in a column of bytes, ``None`` where there are none."""
        found = (value.as_buffer() for value in table.column(name))
        return [None if b is None else np.frombuffer(b, dtype=kind) for b in found]

    def rows(kinds, made):
        return pa.Table.from_pylist(made, schema=pa.schema(kinds))

    whole, raw = pa.int64(), pa.binary()
    paper_rows = [("block", whole), ("peer", whole), ("ids", raw), ("members", raw), ("counts", raw), ("weights", raw)]
    home_rows = [("block", whole), ("peer", whole), ("ids", raw), ("degrees", raw), ("places", raw)]
    vector_rows = [("block", whole), ("peer", whole), ("vector", raw)]

    def pack(batches):
        """The rows of a block as arrays: the ids of its authors by home, and its memberships by paper."""
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        of = column(table, "block")
        for block in np.unique(of):
            mine = table if (of == block).all() else table.filter(pa.array(of == block))
            paper = column(mine, "paper")
            order = np.argsort(paper, kind="stable")
            paper = paper[order]
            starts = np.flatnonzero(np.r_[True, paper[1:] != paper[:-1]])
            counts = np.diff(np.r_[starts, len(paper)]).astype("int32")
            weights = column(mine, "papers")[order][starts].astype("float64")
            ids, members = np.unique(column(mine, "id")[order], return_inverse=True)
            home = numbers[ids % len(numbers)]
            by_home = np.lexsort((ids, home))
            place = np.empty(len(ids), "int32")
            place[by_home] = np.arange(len(ids), dtype="int32")
            ids, home, members = ids[by_home], home[by_home], place[members]
            for peer in np.unique(home):
                here = slice(np.searchsorted(home, peer), np.searchsorted(home, peer, "right"))
                made = {"block": int(block), "peer": int(peer), "ids": ids[here].tobytes()}
                yield from rows(paper_rows, [made]).to_batches()
            ends = np.r_[starts, len(members)]
            cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, len(members), piece)), len(starts)])
            for low, high in zip(cuts[:-1], cuts[1:]):
                made = {
                    "block": int(block),
                    "members": members[ends[low] : ends[high]].tobytes(),
                    "counts": counts[low:high].tobytes(),
                    "weights": weights[low:high].tobytes(),
                }
                yield from rows(paper_rows, [made]).to_batches()

    def settle(authors, wanted):
        """The authors of a home in the order of their ids, and which of them each block of papers has."""
        ids = column(authors, "id")
        order = np.argsort(ids)
        ids, block = ids[order], int(authors.column("block")[0].as_py())
        degrees = column(authors, "outdegree")[order]
        made = [{"block": block, "ids": ids.tobytes(), "degrees": degrees.tobytes()}]
        for peer, have in zip(column(wanted, "peer"), arrays(wanted, "ids", "int64")):
            places = np.searchsorted(ids, have).astype("int32")
            made.append({"block": block, "peer": int(peer), "places": places.tobytes()})
        return rows(home_rows, made)

    def ranked(home, met):
        """The ranks of a home: 1 before the first round, those stored, or from what the blocks of papers sent."""
        degrees = next(d for d in arrays(home, "degrees", "float64") if d is not None)
        places = {p: a for p, a in zip(home.column("peer").to_pylist(), arrays(home, "places", "int32")) if a is not None}
        total = np.zeros(len(degrees))
        if met.num_rows == 0:
            return np.ones(len(degrees)), degrees, places
        for peer, vector in zip(met.column("peer").to_pylist(), arrays(met, "vector", "float64")):
            if peer is None:
                return vector, degrees, places
            total[places[peer]] += vector  # an author is in a block once
        return total * (1 - reset) + reset, degrees, places

    def send(home, met):
        ranks, degrees, places = ranked(home, met)
        share, block = ranks / degrees, int(home.column("block")[0].as_py())
        made = [{"block": p, "peer": block, "vector": share[a].tobytes()} for p, a in places.items()]
        return rows(vector_rows, made)

    def rank(home, met):
        made = {"block": int(home.column("block")[0].as_py()), "vector": ranked(home, met)[0].tobytes()}
        return rows(vector_rows, [made])

    def add(papers, met):
        """What the authors of a block receive: of every paper its total less their own share."""
        sent = sorted(zip(met.column("peer").to_pylist(), arrays(met, "vector", "float64")), key=lambda v: v[0])
        share = np.concatenate([v for _, v in sent])
        total = np.zeros(len(share))
        pieces = zip(arrays(papers, "members", "int32"), arrays(papers, "counts", "int32"), arrays(papers, "weights", "float64"))
        for members, counts, weights in pieces:
            own = share[members]
            sums = np.add.reduceat(own, np.cumsum(counts) - counts)
            received = (np.repeat(sums, counts) - own) * np.repeat(weights, counts)
            total += np.bincount(members, received, len(total))
        block, ends = int(papers.column("block")[0].as_py()), np.cumsum([len(v) for _, v in sent])
        parts = np.split(total, ends[:-1])
        return rows(vector_rows, [{"block": p, "peer": block, "vector": t.tobytes()} for (p, _), t in zip(sent, parts)])

    def unpack(home, met):
        ids = np.concatenate(arrays(home, "ids", "int64"))
        return pa.table({"id": ids, "rank": np.concatenate(arrays(met, "vector", "float64"))})

    return {"pack": pack, "settle": settle, "send": send, "add": add, "rank": rank, "unpack": unpack}
