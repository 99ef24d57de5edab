"""PageRank with a fixed number of rounds.

Every vertex starts at 1; a round sets ``reset + (1 - reset) * sum(rank(u) / outdegree(u))``
over all incoming edges, parallel edges counted each.

``author_pagerank`` never builds the pairs of co-authors. With ``share(u) = rank(u)/outdegree(u)``
the edges of one paper bring its member ``v`` the shares of all other members, that is the
paper's total minus ``share(v)``. One round is thus linear in the number of memberships.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from pubweave.operators import rank_blocks
from pubweave.operators.coauthors import papers
from pubweave.storage import (
    BROADCAST_BYTES,
    Stored,
    bucket_count,
    bucketed_by,
    deal,
    discard,
    kept,
    shuffle_partitions,
    store,
    store_bucketed,
)

ROUNDS_PER_JOB = 5
#: Each round broadcasts the ranks again, through the driver: all rounds together may send this many times
#: what one broadcast may hold.
BROADCASTS = 4
#: How much larger buckets of links and memberships are than others: each of them sends a sum for every vertex
#: that it leads to, once a round.
LARGE = 16
#: Memberships from which rounds over vectors pay for the making of their blocks.
PACKED_FROM = 100_000
#: An author of more papers than this part of a block's memberships doesn't settle where a paper lies.
LEADS = 16


def _may_broadcast(start: Stored, max_iter: int, broadcast_bytes: int) -> bool:
    return start.size * max_iter <= BROADCASTS * broadcast_bytes


def _rounds_by_broadcast(
    start: Stored, one_round: Callable[[DataFrame], DataFrame], max_iter: int
) -> DataFrame:
    """Apply ``one_round`` ``max_iter`` times to small ranks, which are broadcast and written out every
    few rounds. A written table replaces its predecessor. Every round is run."""
    stored, ranks = start, start.table
    for done in range(1, max_iter + 1):
        ranks = one_round(F.broadcast(ranks))
        if done % ROUNDS_PER_JOB and done < max_iter:
            continue
        superseded, stored = stored, store(ranks, "ranks")
        discard(ranks.sparkSession, superseded.path)
        ranks = stored.table
    return ranks


def _rounds_in_place(
    start: Stored,
    one_round: Callable[[DataFrame], DataFrame],
    max_iter: int,
    buckets: int,
) -> DataFrame:
    """The same for ranks of any size: a table in buckets by ``id``, which ``one_round`` returns dealt in
    the same way, so that the old ranks, the new ones and the links of a vertex lie together."""
    spark = start.table.sparkSession
    with shuffle_partitions(spark, buckets):
        ranks = store_bucketed(start.table.repartition(buckets, "id"), "id", buckets)
        for _ in range(max_iter):
            superseded, ranks = ranks, store_bucketed(one_round(ranks.table), "id", buckets)
            superseded.discard()
    return ranks.unlist()


def author_pagerank(
    articles: DataFrame,
    reset: float = 0.15,
    max_iter: int = 50,
    years: tuple[int, int] | None = None,
    authors: str = "authors",
    year: str = "Year",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(id, pagerank)`` of the co-author graph of ``articles``.

    While the measured ranks are small they are broadcast: a round shuffles partial sums per author.
    Beyond that a round has two shuffles, of the shares per paper and of the sums per author, and both
    meet tables that lie in place. They are vectors, of a value per author and block of papers
    (``rank_blocks``). If there are few memberships, or a paper has more of them than a block, they are rows:
    memberships by author and by paper, and the ranks. Authors of very many papers, and papers of very many
    authors, then lie apart (``storage.deal``) and meet few broadcast rows.
    """
    member_sets = papers(articles, years, authors, year).select(
        F.array_sort("members").alias("members")
    )
    # Papers by the same people weigh together. Numbers stand for papers and authors in the
    # rounds, to shuffle 8 bytes per key; they are fixed by being written out.
    stored_groups = store(
        member_sets.groupBy("members")
        .agg(F.count(F.lit(1)).alias("papers"))
        .withColumn("size", F.size("members"))
        .withColumn("paper", F.monotonically_increasing_id()),
        "papers",
    )
    named = stored_groups.table.select(
        "paper",
        "papers",
        (F.col("papers") * (F.col("size") - 1)).alias("links"),
        F.explode("members").alias("name"),
    )
    stored_authors = store(
        named.groupBy("name")
        .agg(
            F.sum("links").alias("outdegree"),
            F.sum("papers").alias("papers"),
            F.count(F.lit(1)).alias("memberships"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "authors",
    )
    by_name = stored_authors.joinable(broadcast_bytes).select("name", "id")
    memberships = named.join(by_name, "name").select("paper", "papers", "id")
    start = store(
        stored_authors.table.select("id", F.lit(1.0).alias("rank"), "outdegree", "papers"), "ranks"
    )
    if _may_broadcast(start, max_iter, broadcast_bytes):
        ranks = _author_rounds(memberships, start, reset, max_iter, stored_groups.size)
    else:
        total, most = stored_groups.table.agg(F.coalesce(F.sum("size"), F.lit(0)), F.max("size")).first()
        if total >= PACKED_FROM and most <= rank_blocks.BLOCK:
            ranks = _author_rounds_in_blocks(stored_groups, stored_authors, by_name, reset, max_iter, total)
        else:
            ranks = _author_rounds_in_place(memberships, start, reset, max_iter, stored_groups.size)
    return ranks.join(stored_authors.joinable(broadcast_bytes), "id").select(
        F.col("name").alias("id"), F.col("rank").alias("pagerank")
    )


def _author_rounds(
    memberships: DataFrame, start: Stored, reset: float, max_iter: int, size: int
) -> DataFrame:
    share = F.col("rank") / F.col("outdegree")
    paper_total = F.sum(share).over(Window.partitionBy("paper"))
    received = (paper_total - share) * F.col("papers")

    with bucketed_by(memberships, "paper", size) as members:

        def one_round(ranks: DataFrame) -> DataFrame:
            return (
                members.join(ranks.select("id", "rank", "outdegree"), "id")
                .select("id", "rank", "outdegree", received.alias("received"))
                .groupBy("id")
                .agg(
                    (F.sum("received") * (1 - reset) + reset).alias("rank"),
                    F.max("outdegree").alias("outdegree"),
                )
            )

        return _rounds_by_broadcast(start, one_round, max_iter)


def _author_rounds_in_blocks(
    groups: Stored, authors: Stored, by_name: DataFrame, reset: float, max_iter: int, total: int
) -> DataFrame:
    blocks = rank_blocks.block_numbers(groups.table.sparkSession, total)
    # Papers lie with one of their members, so that a block has many papers of its authors. Authors of very
    # many papers are left out, for theirs would be a large part of a block; they are few.
    often = authors.table.filter(F.col("memberships") > total // (LEADS * len(blocks)))
    often = often.agg(F.collect_list("name").alias("often"))
    known = F.transform(F.array_except("members", "often"), lambda name: F.xxhash64(name))
    block = rank_blocks.block_of(F.coalesce(F.array_max(known), F.xxhash64("members")), blocks)
    named = groups.table.crossJoin(F.broadcast(often)).select(
        block.alias("block"), "paper", "papers", F.explode("members").alias("name")
    )
    memberships = named.join(by_name, "name").select("block", "paper", "papers", "id")
    return rank_blocks.rounds_in_blocks(memberships, authors.table, reset, max_iter, blocks, ROUNDS_PER_JOB)


def _author_rounds_in_place(
    memberships: DataFrame, start: Stored, reset: float, max_iter: int, size: int
) -> DataFrame:
    spark = memberships.sparkSession
    buckets = bucket_count(spark, size // LARGE)
    written = store(memberships, "memberships")
    by_author = deal(written.table.select("id", "paper"), "id", buckets)
    by_paper = deal(written.table, "paper", buckets)
    share = F.col("rank") / F.col("outdegree")

    def one_round(ranks: DataFrame) -> DataFrame:
        shares = by_author.join(ranks.select("id", share.alias("share"))).select("paper", "share")
        totals = shares.groupBy("paper").agg(F.sum("share").alias("total"))
        met = by_paper.join(totals).select("id", (F.col("total") * F.col("papers")).alias("total"))
        sums = met.groupBy("id").agg(F.sum("total").alias("total"))
        # Every paper's total holds the author's own share.
        received = F.col("total") - share * F.col("papers")
        return sums.join(ranks.hint("shuffle_hash"), "id").select(
            "id", (received * (1 - reset) + reset).alias("rank"), "outdegree", "papers"
        )

    ranks = _rounds_in_place(start, one_round, max_iter, buckets)
    by_author.discard()
    by_paper.discard()
    discard(spark, written.path)
    return ranks


def pagerank(
    edges: DataFrame,
    reset: float = 0.15,
    max_iter: int = 50,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(id, pagerank)`` of any directed graph ``(src, dst, ...)``; ranks sum to the vertex count.

    Parallel edges are first merged into one weighted edge. A zero-weight edge from every vertex
    to itself keeps vertices without incoming edges in the result, so a round is one join and
    one aggregation. Ranks too large to broadcast lie in buckets by vertex, the links by source, those of
    hot sources apart; the one shuffle of a round carries partial sums per target.
    """
    counted = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("edges"))
    counted = counted.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    counted = store(counted, "edges").table
    # Numbers stand for vertices in the rounds, to shuffle 8 bytes per key; they are fixed by being written out.
    ends = counted.select(F.col("src").alias("name"), "edges").union(counted.select("dst", F.lit(0)))
    vertices = store(
        ends.groupBy("name")
        .agg(F.sum("edges").alias("outdegree"))
        .withColumn("id", F.monotonically_increasing_id()),
        "vertices",
    )
    every = vertices.joinable(broadcast_bytes)
    sources = every.select(F.col("name").alias("src"), "id", "outdegree")
    targets = every.select(F.col("name").alias("dst"), F.col("id").alias("target"))
    links = (
        counted.join(targets, "dst")
        .join(sources, "src")
        .select("id", F.col("target").alias("dst"), (F.col("edges") / F.col("outdegree")).alias("weight"))
    )
    start = store(vertices.table.select("id", F.lit(1.0).alias("rank")), "ranks")
    loops = start.table.select("id", F.col("id").alias("dst"), F.lit(0.0).alias("weight"))
    links = links.unionByName(loops)

    def one_round(met: DataFrame) -> DataFrame:
        received = F.sum(F.col("weight") * F.col("rank"))
        return met.groupBy("dst").agg((received * (1 - reset) + reset).alias("rank")).withColumnRenamed("dst", "id")

    if _may_broadcast(start, max_iter, broadcast_bytes):
        # Not bucketed by target: a vertex that a third of all edges point to would be one task.
        with kept(links, "links") as stored:
            ranks = _rounds_by_broadcast(start, lambda r: one_round(stored.join(r, "id")), max_iter)
    else:
        spark = edges.sparkSession
        written = store(links, "links")
        buckets = bucket_count(spark, written.size // LARGE)
        dealt = deal(written.table, "id", buckets)
        ranks = _rounds_in_place(start, lambda r: one_round(dealt.join(r)), max_iter, buckets)
        dealt.discard()
        discard(spark, written.path)
    # Rank that reaches a vertex without outgoing edges is lost; the sum is put right at the end.
    scale = ranks.agg(F.count(F.lit(1)) / F.sum("rank")).first()[0]
    return ranks.join(every, "id").select(
        F.col("name").alias("id"), (F.col("rank") * F.lit(scale)).alias("pagerank")
    )


def top_authors(ranks: DataFrame, n: int = 50, digits: int | None = None) -> DataFrame:
    """The ``n`` highest ranks, ties by id.

    ``digits`` rounds before ordering, so equal ranks that differ only in summation order tie.
    """
    value = F.col("pagerank") if digits is None else F.round("pagerank", digits)
    return (
        ranks.select("id", value.alias("pagerank"))
        .orderBy(F.desc("pagerank"), F.asc("id"))
        .limit(n)
    )
