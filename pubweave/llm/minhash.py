"""Near-duplicate documents by consistent weighted sampling.

A document is the weighted set of its shingles of five words (lower case, split at white space). A
shingle weighs ``(1 + ln tf) * (1 + scale * ln(N / df) / ln(buckets))``: its frequency in the text, damped,
times a damped inverse document frequency. The damping keeps the similarity close to the plain Jaccard
one, so that a large group of near copies, whose common shingles are frequent by that very fact, stays
together. Document frequencies are counted over all documents in ``buckets`` hashed counters, a table of
fixed size whatever the input, which is what is broadcast.

Improved consistent weighted sampling draws ``bands * rows`` samples a document; two documents agree in a
sample with the probability of their weighted Jaccard similarity. Documents that agree in all samples
of a band meet in a bucket, and every pair that meets is verified by its weighted Jaccard similarity on
the shingles themselves, once, in the first band where it meets. Equal word sequences are one class
before that. Classes are the connected components of the verified links.

Large buckets are split into tiles of bounded size (``tiles``), so no task holds a group, and a tile
returns links as a forest: no list of all pairs is ever made.

A text of one to four words is a single shingle; a text without words (null, empty, blank) is in a class
of its own. Rows that share a ``doc_id`` count as one document. Rows without a ``doc_id`` are in no
class. Ties: a class bears its least ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from pubweave.llm.common import column, columns, ship, store
from pubweave.llm.components import components
from pubweave.llm.hashing import MIX, U64, hashed_words, rolled, slices, spread
from pubweave.llm.tiles import Forest, in_tiles, tiled

ELEMENT_BITS = 48
ELEMENT = U64((1 << ELEMENT_BITS) - 1)


@dataclass(frozen=True)
class Settings:
    """``similarity``: least weighted Jaccard similarity of a link. ``bands`` of ``rows`` samples find a
    pair of similarity s with probability ``1 - (1 - s**rows)**bands``: 0.9998 at 0.8.
    ``tile_rows`` and ``tile_words`` bound a block of a tile."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 16
    rows: int = 4
    buckets: int = 1 << 18
    scale: float = 0.25
    tile_rows: int = 400
    tile_words: int = 400_000
    seed: int = 20


@dataclass(frozen=True)
class Shingles:
    """The distinct shingles of some texts: ``element`` and ``times`` of text k are at
    ``starts[k]:starts[k + 1]``, ascending. ``words`` counts words, ``whole`` two hashes of the word
    sequence."""

    element: np.ndarray
    times: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    whole: np.ndarray


def shingles(texts: pa.Array, width: int) -> Shingles:
    """Of at most 65,536 texts."""
    lower = lambda t: pc.utf8_split_whitespace(pc.utf8_lower(t))
    found = hashed_words(texts, lower)
    word, text, place, words = found.word, found.text, found.place, found.count
    count = len(texts)
    first = np.concatenate([[0], np.cumsum(words)])

    whole = np.zeros((2, count), U64)
    for row, factor in enumerate(MIX[:2]):
        mixed = spread(word + (place.astype(U64) + U64(1)) * factor)
        sums = np.concatenate([[U64(0)], np.cumsum(mixed, dtype=U64)])
        whole[row] = sums[first[1:]] - sums[first[:-1]]

    short = (words > 0) & (words < width)
    inside = place <= words[text] - width
    owner = np.concatenate([text[inside], np.flatnonzero(short)])
    hashed = np.concatenate([rolled(word, width)[inside], spread(whole[0][short])])
    keys = np.sort((owner.astype(U64) << U64(ELEMENT_BITS)) | (hashed >> U64(64 - ELEMENT_BITS)))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys[:0].astype(int)
    distinct = keys[new]
    times = np.diff(np.concatenate([new, [len(keys)]]))
    starts = np.searchsorted(distinct >> U64(ELEMENT_BITS), np.arange(count + 1).astype(U64))
    return Shingles(distinct & ELEMENT, times, starts, words, whole)


def document_frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Documents by hashed shingle, over all of ``texts``, and the number of documents."""
    buckets = settings.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingles(part.column("text"), settings.words)
                total += np.bincount(found.element & U64(buckets - 1), minlength=buckets)
                documents += part.num_rows
        filled = np.flatnonzero(total)
        yield pa.record_batch(
            {
                "bucket": np.concatenate([[-1], filled]),
                "n": np.concatenate([[documents], total[filled]]),
            }
        )

    counted = texts.select("text").mapInArrow(count, "bucket long, n long")
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = summed.column("bucket").to_numpy(), summed.column("n").to_numpy()
    frequencies = np.zeros(buckets, np.int64)
    frequencies[bucket[bucket >= 0]] = n[bucket >= 0]
    return frequencies, int(n[bucket < 0].sum())


def idf(frequencies: np.ndarray, documents: int, settings: Settings) -> np.ndarray:
    rarity = np.log(max(documents, 1) / np.maximum(frequencies, 1)) / log(settings.buckets)
    return 1 + settings.scale * np.maximum(rarity, 0)


def weights(found: Shingles, rarity: np.ndarray) -> np.ndarray:
    return (1 + np.log(found.times)) * rarity[found.element & U64(len(rarity) - 1)]


class Sampler:
    """Improved consistent weighted sampling.

    For sample k, a shingle's hash picks r and c, gamma variates of shape 2, and the uniform b. With
    ``t = floor(ln w / r + b)`` the sample is the (shingle, t) of least ``ln c - r * (t - b) - r``. The
    variates lie in a table, as ``1 / r``, ``b``, ``ln c + r * b - r`` and ``r``.
    """

    TABLE_BITS = 15

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        size = 1 << self.TABLE_BITS
        r, c, b = rng.gamma(2, 1, size), rng.gamma(2, 1, size), rng.random(size)
        columns = (1 / r, b, np.log(c) + r * b - r, r)
        self.inverse, self.shift, self.base, self.r = (x.astype(np.float32) for x in columns)
        many = settings.bands * settings.rows
        self.factors = rng.integers(1 << 62, size=many, dtype=np.uint64) * U64(2) + U64(1)
        self.settings = settings

    def draw(self, element: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(samples, texts); ``starts`` are those of texts with a shingle, without the end."""
        logs = np.log(weight).astype(np.float32)
        made = np.empty((len(self.factors), len(starts)), U64)
        key = np.empty(len(element), U64)
        step = 1 << 15
        for k, factor in enumerate(self.factors):
            for at in range(0, len(element), step):
                mixed = element[at : at + step] * factor
                index = (mixed >> U64(64 - self.TABLE_BITS)).astype(np.int32)
                t = np.floor(logs[at : at + step] * self.inverse[index] + self.shift[index])
                bits = (self.base[index] - self.r[index] * t).view(np.uint32)
                order = bits ^ np.where(bits >> 31, np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
                name = (mixed >> U64(8)).astype(np.uint32) + t.astype(np.int32).view(np.uint32) * np.uint32(
                    0x9E3779B1
                )
                key[at : at + step] = (order.astype(U64) << U64(32)) | name
            made[k] = np.minimum.reduceat(key, starts)
        return made

    def bands(self, samples: np.ndarray) -> np.ndarray:
        """(texts, bands): a hash of the samples of each band."""
        s = self.settings
        names = (samples & U64(0xFFFFFFFF)).reshape(s.bands, s.rows, -1)
        made = np.zeros((s.bands, samples.shape[1]), U64)
        for row in range(s.rows):
            made = spread(made * MIX[0] + names[:, row] + U64(row + 1))
        return made.T


def signatures(texts: DataFrame, rarity: Broadcast, settings: Settings) -> DataFrame:
    """(doc_id, whole_a, whole_b, words, bands) of each text; ``bands`` is null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(settings)
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingles(part.column("text"), settings.words)
                full = np.flatnonzero(np.diff(found.starts))
                keys = np.zeros((len(found.words), settings.bands), np.int64)
                if len(full):
                    drawn = sampler.draw(
                        found.element, weights(found, rarity.value), found.starts[full]
                    )
                    keys[full] = sampler.bands(drawn).view(np.int64)
                offsets = np.arange(len(keys) + 1, dtype=np.int32) * settings.bands
                bands = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=np.append(found.words == 0, False)), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(found.whole[0].view(np.int64)),
                        pa.array(found.whole[1].view(np.int64)),
                        pa.array(found.words.astype(np.int64)),
                        bands,
                    ],
                    ["doc_id", "whole_a", "whole_b", "words", "bands"],
                )

    schema = "doc_id long, whole_a long, whole_b long, words long, bands array<long>"
    return texts.select("doc_id", "text").mapInArrow(sign, schema)


def meetings(classes: DataFrame, settings: Settings) -> DataFrame:
    """(band, key, n, total, doc_id, bands): the members of each bucket of two or more. Of buckets with
    the same members only the one of the lowest band stays."""
    keyed = classes.select("doc_id", "words", F.posexplode("bands").alias("band", "key"))
    same = [F.bit_xor(F.xxhash64("doc_id", F.lit(k))).alias(f"same_{k}") for k in (0, 1)]
    buckets = keyed.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum("words").alias("total"), *same
    )
    kept = (
        buckets.where("n > 1")
        .groupBy("n", "total", "same_0", "same_1")
        .agg(F.min(F.struct("band", "key")).alias("bucket"))
        .select("bucket.*", "n", "total")
    )
    members = classes.select("doc_id", "bands", F.posexplode("bands").alias("band", "key"))
    return members.join(kept, ["band", "key"])


def verified(tiles: DataFrame, rarity: Broadcast, settings: Settings) -> DataFrame:
    """Links as (a, b): a forest for each tile, over all its pairs that first meet in its band."""

    def work(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = table.to_batches()[0] if len(table.to_batches()) == 1 else table.combine_chunks().to_batches()[0]
        ids = rows.column("doc_id").to_numpy()
        band = rows.column("band").to_numpy()
        block, low, high = (rows.column(c).to_numpy() for c in ("block", "tile_row", "tile_column"))
        keys = rows.column("bands").flatten().to_numpy().reshape(-1, settings.bands)
        left, right = [], []
        start = 0
        while start < len(edges) - 1:  # some tiles at a time, for bounded memory
            stop = start + 1
            while stop < len(edges) - 1 and edges[stop + 1] - edges[start] <= 2048:
                stop += 1
            at = edges[start]
            found = shingles(rows.column("text").slice(at, edges[stop] - at), settings.words)
            weight = weights(found, rarity.value)
            for a, b in zip(edges[start:stop], edges[start + 1 : stop + 1], strict=True):
                linked = tile_links(
                    found, weight, slice(a - at, b - at), keys[a:b], int(band[a]),
                    block[a:b], int(low[a]), int(high[a]), settings.similarity,
                )
                for x, y in linked:
                    left.append(ids[a + x])
                    right.append(ids[a + y])
            start = stop
        yield pa.record_batch({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return in_tiles(tiles, ["band", "key"], work, "a long, b long")


def tile_links(
    found: Shingles, weight: np.ndarray, own: slice, keys: np.ndarray, band: int,
    block: np.ndarray, low: int, high: int, similarity: float,
) -> list[tuple[int, int]]:
    """Positions of linked members, as a forest."""
    begin, end = found.starts[own.start], found.starts[own.stop]
    known, element = np.unique(found.element[begin:end], return_inverse=True)
    weight = weight[begin:end]
    starts = found.starts[own.start : own.stop + 1] - begin
    sums = np.add.reduceat(np.append(weight, 0.0), starts[:-1])
    count = len(keys)
    forest, mark = Forest(count), np.zeros(len(known))
    rows = np.flatnonzero(block == low)
    columns = np.flatnonzero(block == high)
    for a in rows.tolist():
        others = columns[columns > a] if low == high else columns
        if band:
            others = others[~(keys[others, :band] == keys[a, :band]).any(1)]
        # What the two sums allow at most.
        others = others[np.minimum(sums[others], sums[a]) >= similarity * np.maximum(sums[others], sums[a]) - 1e-9]
        if not len(others):
            continue
        mine = slice(starts[a], starts[a + 1])
        mark[element[mine]] = weight[mine]
        lengths = starts[others + 1] - starts[others]
        at = np.concatenate([[0], np.cumsum(lengths)])
        index = np.arange(at[-1]) + np.repeat(starts[others] - at[:-1], lengths)
        shared = np.add.reduceat(np.minimum(weight[index], mark[element[index]]), at[:-1])
        mark[element[mine]] = 0
        alike = shared >= similarity * (sums[a] + sums[others] - shared) - 1e-9
        for b in others[alike].tolist():
            forest.join(a, b)
    return [(x, root) for x in range(count) if (root := forest.root(x)) != x]


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, class_id): a row for each ``doc_id``; ``class_id`` is the least ``doc_id`` of its class."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    frequencies, documents = document_frequencies(texts, settings)
    rarity = spark.sparkContext.broadcast(idf(frequencies, documents, settings))
    signed = store(signatures(texts, rarity, settings), "signatures").table.where("doc_id is not null")
    classes = store(
        signed.where("words > 0")
        .groupBy("whole_a", "whole_b", "words")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")),
        "classes",
    ).table
    members = meetings(classes, settings)
    blocks = F.greatest(
        F.ceil(F.col("n") / settings.tile_rows), F.ceil(F.col("total") / settings.tile_words)
    )
    tiles = tiled(members, blocks, "doc_id").drop("n", "total")
    with_text = tiles.join(texts, "doc_id")
    links = verified(with_text, rarity, settings)
    copies = signed.join(
        classes.select(F.col("doc_id").alias("b"), "whole_a", "whole_b", "words"),
        ["whole_a", "whole_b", "words"],
    )
    edges = links.unionByName(copies.select(F.col("doc_id").alias("a"), "b").where("a <> b"))
    found = components(edges)
    ids = signed.select("doc_id").distinct()
    joined = ids.join(found, ids.doc_id == found.node, "left")
    return joined.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents whose class has a lesser ``doc_id``; rows without a ``doc_id``
    stay."""
    later = near_duplicates(docs, settings).where("class_id < doc_id").select(F.col("doc_id").alias("later"))
    own = docs.select(F.struct(*columns(docs)).alias("row"))
    kept = own.join(later, own["row.doc_id"] == later["later"], "left_anti")
    return kept.select("row.*")
