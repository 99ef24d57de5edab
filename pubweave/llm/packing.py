"""Best-fit packing into bins of several permitted sizes.

Pieces are placed longest first, each into the open bin with the least room that still holds it. If no
bin does, one is opened: of the sizes that may be opened and hold the piece, the one in which a token
costs least once the longest of the later pieces that fit are in it; the smallest permitted size that
holds the piece if none of them does. In the end each bin is downsized to the smallest permitted size that
holds its contents. Which sizes may be opened is optimised jointly: the placement is made with each set of
permitted sizes, the empty one too, and the cheapest outcome counts.

Each shard of about ``Sizes.shard`` pieces is packed by itself, so no task grows with the input, and
thousands of pieces leave hardly any room unused. Equal rows are counted as one first; their copies are
dealt out by their number, other pieces by a hash of what they are, so two stored copies of a table, or
clusters of different size, make the same bins. The unit of length is the word
unless the caller brings lengths. Texts longer than the largest size are cut between words into pieces of
that size; pieces of a text concatenate to it. Texts without a word (null, empty, blank) need no room:
they are in no bin. Repeated rows are packed as often as they come; ties go by ``doc_id`` and piece.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pubweave.llm.common import SEPARATORS, ship, store

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the separators after it, the first one also with those before it.
UNIT = rf"(?:^{SEPARATORS})?{WORD}(?:{SEPARATORS})?"

BIN = (
    "bin_id long, bin_size long, bin_used long, doc_ids array<long>, pieces array<long>, "
    "starts array<long>, lengths array<long>, offsets array<long>, texts array<string>"
)


@dataclass(frozen=True)
class Sizes:
    """Permitted sizes, ascending. A bin costs its size, and a share of its square for attention."""

    permitted: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    square: float = 1 / 65536
    shard: int = 4000

    def cost(self, size: int) -> float:
        return size + self.square * size * size

    def holding(self, length: int) -> int:
        return self.permitted[bisect_left(self.permitted, length)]


class Filled:
    """What a token costs in a bin that is opened for a piece and filled with the longest of the later
    pieces that still fit, by position of the piece and size. Pieces are as in ``place``."""

    def __init__(self, lengths: list[int], sizes: Sizes):
        self.sizes = sizes
        self.known: dict[tuple[int, int], float] = {}
        self.values = sorted(set(lengths))
        self.rank = {length: k for k, length in enumerate(self.values)}
        self.lengths = lengths
        ends = {length: end for end, length in enumerate(lengths, 1)}
        self.ends = [ends[length] for length in self.values]
        self.starts = [*self.ends[1:], 0]

    def cost(self, item: int, size: int) -> float:
        found = self.known.get((item, size))
        if found is None:
            used = self.used(item, size)
            found = self.known[item, size] = self.sizes.cost(self.sizes.holding(used)) / used
        return found

    def used(self, item: int, size: int) -> int:
        rank, room, first = self.rank[self.lengths[item]], size, item
        while rank >= 0:
            length = self.values[rank]
            room -= length * min(room // length, self.ends[rank] - max(first, self.starts[rank]))
            rank = min(rank, bisect_right(self.values, room)) - 1
        return size - room


def place(
    lengths: list[int], allowed: tuple[int, ...], sizes: Sizes, filled: Filled | None = None
) -> list[list[int]]:
    """Bins, as lists of positions in ``lengths``, which must descend."""
    filled = filled or Filled(lengths, sizes)
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    for item, length in enumerate(lengths):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            holding = allowed[bisect_left(allowed, length) :] or (sizes.holding(length),)
            room = holding[0]
            if len(holding) > 1:
                room = min(holding, key=lambda s: (filled.cost(item, s), s))
            number = len(bins)
            bins.append([])
        bins[number].append(item)
        if room > length:
            insort(rooms, (room - length, number))
    return bins


def pack_lengths(lengths: list[int], sizes: Sizes) -> list[tuple[int, list[int]]]:
    """The cheapest outcome over all sets of sizes that may be opened: (size, positions) a bin."""
    best: tuple[float, list[tuple[int, list[int]]]] | None = None
    filled = Filled(lengths, sizes)
    for k in range(len(sizes.permitted) + 1):
        for allowed in combinations(sizes.permitted, k):
            bins = place(lengths, allowed, sizes, filled)
            sized = [(sizes.holding(sum(lengths[i] for i in b)), b) for b in bins]
            cost = sum(sizes.cost(size) for size, _ in sized)
            if best is None or cost < best[0]:
                best = cost, sized
    return best[1] if best else []


def distinct_rows(docs: DataFrame, texts: bool) -> DataFrame:
    """(doc_id, words, tie, text, copies): equal rows as one, with the number of their words and of them;
    ``tie`` is a hash of the text. Without ``texts`` rows of one ``doc_id`` and length are equal."""
    text = F.coalesce("text", F.lit(""))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        (F.xxhash64("text") if texts else F.lit(0).cast("long")).alias("tie"),
        (text if texts else F.lit(None).cast("string")).alias("text"),
    ).where("words > 0")
    return counted.groupBy("doc_id", "words", "tie", "text").agg(F.count(F.lit(1)).alias("copies"))


def pieces_of(rows: DataFrame, sizes: Sizes) -> DataFrame:
    """(doc_id, tie, copy, piece, start, length, text) of all copies."""
    most = sizes.permitted[-1]
    every = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    units = F.regexp_extract_all("text", F.lit(UNIT), 0)
    cut_text = F.when(F.col("text").isNotNull() & (F.col("words") <= most), F.array("text")).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / most)),
            lambda k: F.array_join(F.slice("units", (k * most + 1).cast("int"), F.lit(most)), ""),
        )
    )
    with_units = every.withColumn("units", F.when(F.col("words") > most, units))
    cut = with_units.select("doc_id", "tie", "copy", "words", F.posexplode(cut_text).alias("piece", "text"))
    start = F.col("piece").cast("long") * most
    return cut.select(
        "doc_id",
        "tie",
        "copy",
        F.col("piece").cast("long").alias("piece"),
        start.alias("start"),
        F.least(F.lit(most).cast("long"), F.col("words") - start).alias("length"),
        "text",
    )


def pack(docs: DataFrame, sizes: Sizes = Sizes(), texts: bool = True) -> DataFrame:
    """A row per bin: its id, size and use, and lists that run in parallel: which piece of which document
    starts where in its text, how long it is, where it lies in the bin, and its text. The bins depend on the
    rows alone, not on how they are stored or on the cluster."""
    ship(docs.sparkSession)
    rows = store(distinct_rows(docs, texts), "packed").table
    most = sizes.permitted[-1]
    total = rows.agg(F.sum(F.col("copies") * F.ceil(F.col("words") / most))).first()[0] or 0
    shards = max(1, -(-int(total) // sizes.shard))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "length", "tie", "copy"), F.lit(shards))
    # A shard is costly though it is small, so they are not joined to larger partitions.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = min(shards, max(8 * cores, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(bins_of(rows, sizes), columns=[c.split()[0] for c in BIN.split(", ")])

    dealt = pieces_of(rows, sizes).withColumn("shard", shard).repartition(tasks, "shard")
    return dealt.groupBy("shard").applyInPandas(packed, BIN)


def bins_of(rows: pd.DataFrame, sizes: Sizes) -> Iterable[tuple]:
    order = ["length", "doc_id", "piece", "tie", "copy"]
    rows = rows.sort_values(order, ascending=[False, True, True, True, True], kind="stable")
    lengths, shard = rows["length"].tolist(), int(rows["shard"].iloc[0])
    columns = {c: rows[c].tolist() for c in ("doc_id", "piece", "start", "text")}
    ids = [None if pd.isna(d) else int(d) for d in columns["doc_id"]]
    for number, (size, items) in enumerate(pack_lengths(lengths, sizes)):
        offsets, used = [], 0
        for i in items:
            offsets.append(used)
            used += lengths[i]
        yield (
            (shard << 32) + number,
            size,
            used,
            [ids[i] for i in items],
            [columns["piece"][i] for i in items],
            [columns["start"][i] for i in items],
            [lengths[i] for i in items],
            offsets,
            [columns["text"][i] for i in items],
        )


def placed(bins: DataFrame) -> DataFrame:
    """A row per piece, from a row per bin."""
    lists = F.arrays_zip("doc_ids", "pieces", "starts", "lengths", "offsets")
    rows = bins.select("bin_id", "bin_size", "bin_used", F.explode(lists).alias("p"))
    return rows.select(
        F.col("p.doc_ids").alias("doc_id"),
        F.col("p.pieces").alias("piece"),
        F.col("p.starts").alias("start"),
        F.col("p.lengths").alias("n_words"),
        "bin_id",
        F.col("p.offsets").alias("bin_offset"),
        "bin_size",
        "bin_used",
    )
