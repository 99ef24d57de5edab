"""Periodic runs: stretches of consecutive words that repeat a shorter sequence of words.

A run is a stretch with smallest period q (words q apart are identical) and at least ``max(least, 2 * q)``
words which no neighbouring word extends keeping that period. Where words q apart agree for q words on
end, the stretch is at least 2 q long; so the work is to find, for each q, the intervals of places that
agree with the place q further on.

Periods go by octaves. Every interval of an octave that counts holds one of the equally spaced blocks of
``block`` words whole (``octaves``), so a document is exploded into tiles, one a block and octave, which
overlap: a tile is the block with as many words as the octave's periods reach. Only tiles whose block
recurs at a distance of the octave are sent; the others hold no interval. Tiles are dealt evenly over
tasks, and each is solved by itself: the Z-function of the tile from its block on, and that of the
reversed words before it, give for each period how far the agreement reaches on both sides, cut at the
neighbouring blocks. Periods that are multiples of a smaller one are left out: the block shows it, and in
every tile alike. The fragments are shuffled by document and period, and fragments that touch are stitched
into whole intervals by a window over their order.

A block is first compared by a 64-bit name, made by doubling, which only decides what is sent; results
come from the words themselves. A tile of a period q has about 5 q words, so the memory of a task grows
with the longest period of a text, and with the length of one text.

Rows are told apart as in ``spans``; copies of a row share their result, and rows without a ``doc_id``
are documents too. Null, empty and blank texts have no runs. Runs of one document don't depend on
others, so ties and equal rows need no rule; runs of different periods may overlap. Only ``doc_id`` and
``text`` are read; other columns stay, and a clash makes the new name longer. An empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from pubweave.llm.common import column, columns, fresh, ship, store, tasks_for
from pubweave.llm.hashing import MIX, U64, hashed_words, slices, spread
from pubweave.llm.spans import KEY, Split, cleaned, covered, flat_lists, joined, keyed

LEAST = 12
TILES = "salt long, doc_id long, mark long, block int, low int, high int, start long, size int, words binary"
FRAGMENTS = "doc_id long, mark long, period int, first long, end long"
#: Words of tiles in a batch, and text for a chunk and for a task that solves tiles.
TILE_WORDS = 1 << 18
CHUNK_BYTES = 2 << 20
PART_BYTES = 16 << 20


@dataclass(frozen=True)
class Octave:
    """Periods ``low`` to ``high`` - 1, and the length of their blocks: an interval of at least
    ``2 * block - 1`` places holds an aligned one."""

    low: int
    high: int
    block: int


def octaves(longest: int, least: int = LEAST) -> Iterator[Octave]:
    """Octaves of the periods up to ``longest``. A run of period q has an interval of at least
    ``max(q, least - q)`` places: the first octave's shortest is ``(least + 1) // 2``."""
    low, high, block = 1, 8, ((least + 1) // 2 + 1) // 2
    while low <= longest:
        yield Octave(low, high, block)
        low, high, block = high, 2 * high, high // 2


def block_names(words: np.ndarray, block: int) -> np.ndarray:
    """A name of each run of ``block`` words, at its first word: equal for equal runs, and hardly ever for
    others. Those that the end cuts short have some other name."""

    def followed(left: np.ndarray, right: np.ndarray, by: int, factor: np.uint64) -> np.ndarray:
        made = left * factor
        made[: max(len(left) - by, 0)] += right[by:]
        return made

    names, size, made, place = words, 1, None, 0
    while True:
        if block & 1:
            made = names if made is None else followed(made, names, place, MIX[0])
            place += size
        block >>= 1
        if not block:
            return made
        # Another factor for each length: words hold no pattern that all of them share.
        names, size = followed(names, names, size, MIX[1] ^ U64(2 * size)), size * 2


def blocks_that_recur(names: np.ndarray, octave: Octave) -> np.ndarray:
    """Starts of aligned blocks with an equal one at a distance of the octave."""
    count, step = len(names), octave.block
    starts = np.arange(0, count, step)
    found = np.zeros(len(starts), bool)
    if octave.high - octave.low <= len(starts):
        own = names[::step]
        for q in range(octave.low, min(octave.high, count)):
            ahead = names[q::step]
            found[: len(ahead)] |= own[: len(ahead)] == ahead
    else:
        for k, start in enumerate(starts.tolist()):
            found[k] = (names[start + octave.low : start + octave.high] == names[start]).any()
    return starts[found]


def z_function(words: list[int]) -> list[int]:
    """For each place the length of the longest common beginning of all words and those from it on."""
    total = len(words)
    z = [0] * total
    left = right = 0
    for i in range(1, total):
        size = min(right - i, z[i - left]) if i < right else 0
        while i + size < total and words[size] == words[i + size]:
            size += 1
        z[i] = size
        if i + size > right:
            left, right = i, i + size
    return z


@lru_cache(1 << 16)
def prime_factors(number: int) -> tuple[int, ...]:
    found, factor = [], 2
    while factor * factor <= number:
        if number % factor == 0:
            found.append(factor)
            while number % factor == 0:
                number //= factor
        factor += 1
    return tuple(found + [number] * (number > 1))


def solve(words: list[int], start: int, octave: Octave) -> Iterator[tuple[int, int, int]]:
    """Period, first and end of the intervals around the block at ``start`` of the tile's words, cut a
    block before it and a block after it."""
    block = octave.block
    ahead = z_function(words[start:])
    back: list[int] | None = None
    for q in range(octave.low, min(octave.high, len(words) - start)):
        if ahead[q] < block or any(ahead[q // r] >= q - q // r for r in prime_factors(q)):
            continue
        if back is None:
            before = words[:start][::-1]
            reach = words[: start + octave.high][::-1]
            back = z_function([*before, -1, *reach])[len(before) + 1 :][::-1]
            offset = len(back) - len(reach)
        reached = back[start + q - 1 - offset] if start else 0
        yield q, start - min(reached, block), start + min(ahead[q], 2 * block)


def chunk_tiles(docs: pa.RecordBatch, least: int) -> Iterator[pa.RecordBatch]:
    """The tiles of a chunk of documents whose blocks recur, as in ``TILES``."""
    found = hashed_words(docs.column("text"), pc.ascii_split_whitespace)
    total = len(docs)
    starts = np.concatenate([[0], np.cumsum(found.count)])
    if not len(found.word):
        return
    # One word that occurs nowhere else after each document, so that no block crosses its end.
    marks = spread(np.arange(total, dtype=U64) + MIX[2])
    words = np.insert(found.word, starts[1:], marks)
    first = starts + np.arange(total + 1)
    owner = np.repeat(np.arange(total), found.count + 1)
    coded = np.unique(words, return_inverse=True)[1].astype("<i4")
    rows: list[tuple] = []
    held = 0
    for octave in octaves(int(found.count.max()) // 2, least):
        names = block_names(words, octave.block)
        for at in blocks_that_recur(names, octave).tolist():
            doc = int(owner[at])
            low = max(at - octave.block, int(first[doc]))
            high = min(at + 2 * octave.block + octave.high, int(first[doc + 1]) - 1)
            if at + octave.low >= high:
                continue
            tile = coded[low:high]
            rows.append((doc, octave.block, octave.low, octave.high, low - int(first[doc]), at - low, tile.tobytes()))
            held += len(tile)
            if held >= TILE_WORDS:
                yield tile_rows(docs, rows)
                rows, held = [], 0
    if rows:
        yield tile_rows(docs, rows)


def tile_rows(docs: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    owner, block, low, high, start, size, words = zip(*rows, strict=True)
    keys = [docs.column(k).take(pa.array(owner)) for k in KEY]
    ints = [pa.array(v, pa.int32()) for v in (block, low, high)]
    made = [*keys, *ints, pa.array(start, pa.int64()), pa.array(size, pa.int32()), pa.array(words, pa.binary())]
    return pa.record_batch(made, names_of(TILES)[1:])


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with a number for each row in front, which deals equal rows evenly and repeats with the
    task."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        salt = pa.array(np.arange(number, number + len(batch)))
        number += len(batch)
        yield pa.record_batch([salt, *batch.columns], ["salt", *batch.schema.names])


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], "<i4").tolist()
            octave = Octave(row["low"], row["high"], row["block"])
            for q, first, end in solve(words, row["size"], octave):
                rows.append((row["doc_id"], row["mark"], q, row["start"] + first, row["start"] + end))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            made = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch(made, names_of(FRAGMENTS))


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """A row for each run of each document: ``doc_id``, ``mark``, ``start``, ``length``, ``period``."""
    ship(docs.sparkSession)

    texts = keyed(docs)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (chunk for batch in batches for chunk in slices(batch, "text", CHUNK_BYTES))
        return salted(tile for chunk in chunks for tile in chunk_tiles(chunk, least))

    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tiles = texts.mapInArrow(explode, TILES).repartition(tasks_for(docs, size, PART_BYTES), "salt")
    fragments = store(tiles.mapInArrow(solved, FRAGMENTS), "fragments").table.distinct()
    # Fragments that touch those before them belong to one interval.
    within = Window.partitionBy(*KEY, "period").orderBy("first", "end")
    reached = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.withColumn("new", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
    numbered = parts.withColumn("part", F.sum("new").over(within))
    whole = numbered.groupBy(*KEY, "period", "part").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    runs = whole.withColumn("length", length).where(
        F.col("length") >= F.greatest(F.lit(least), 2 * F.col("period"))
    )
    return runs.select(*KEY, "start", "length", F.col("period").cast("long").alias("period"))


def runs_by_document(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``mark`` and ``runs``, a list of (start, period, length) in that order."""
    runs = periodic_runs(docs, least)
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return store(runs.groupBy(*KEY).agg(listed.alias("runs")), "runs").table


def repeated_periods(found: Split, texts: pa.Array, runs: pa.Array) -> np.ndarray:
    """The words of runs after their first period."""
    owner, items = flat_lists(runs)
    start, period, length = (items.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    return covered(found, owner, start + period, start + length)


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Every row with ``runs`` (an empty list if none), and ``cleaned``: ``n_words``, ``n_removed``, and
    ``kept``, its words without those after the first period of a run, joined by one space."""
    both, runs = joined(docs, runs_by_document(docs, least), "runs")
    out = fresh(both, "cleaned")
    made = cleaned(column("text").cast("string"), column(runs), repeated_periods)
    empty = F.array().cast(both.schema[runs].dataType)
    return both.withColumn(out, made).select(
        *columns(docs), F.coalesce(column(runs), empty).alias(runs), column(out)
    )


def longest_run(runs: Column) -> Column:
    """The run with the greatest length; of these the first, and of these that of the least period."""
    better = lambda a, b: F.when(a.isNull() | (b["length"] > a["length"]), b).otherwise(a)
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, better)
