"""Language-model scores with stupid backoff.

A text's score is the sum over its words of ``ln S(word | the two words before)``, where S is the share
of the n-gram among the n-grams with the same beginning if the n-gram was counted, and otherwise
``Settings.backoff`` times S of the shorter n-gram. All counts are over the whole table, from one on.

The work is relational. Texts are gathered into chunks of bounded size, which are written once. A chunk
explodes its texts into n-grams and sends each distinct one, with its count, to the partition of the
count table that its hash names; packed, all of a chunk for a partition in one row. Each partition adds up
its counts and joins them back to the rows it got, which return to their chunks, where in the end the
scores are summed by document. The longest n-grams go in a round of their own, so that the disk holds one
size at a time, and each round is a table in the shared folder. Hot n-grams are counted in each chunk
first, so a partition gets one a chunk at most, and both chunks and partitions are as many as the size of
the table asks for.

Words are runs without ASCII separators, as written. Null and blank texts have no words: their score is
0 and their mean null. Repeated rows are counted and returned as often as they come. A chunk holds whole
texts: a text longer than ``chunk_bytes`` is a chunk of its own, in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pubweave.llm.common import ship, store, tasks_for
from pubweave.llm.hashing import U64, Words, hashed_words, released, rolled, slices

CHUNKS = "chunk long, bytes long, docs binary"
GRAMS = "size int, part int, chunk long, grams binary, counts binary"
FOUND = "size int, part int, chunk long, counts binary"
SCORES = "doc_id long, n_tokens long, log_score double, mean_log_score double"


@dataclass(frozen=True)
class Settings:
    """``order``: the longest n-grams. ``chunk_bytes`` and ``part_bytes``: text for a chunk, and for a
    partition of the count tables."""

    order: int = 3
    backoff: float = 0.4
    chunk_bytes: int = 2 << 20
    part_bytes: int = 4 << 20


def shuffled(values: np.ndarray) -> bytes:
    """Numbers with their bytes dealt into planes, which compress well in a shuffle."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unshuffled(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def ends(found: Words, size: int) -> np.ndarray:
    """Positions of the words that end an n-gram of this size."""
    return np.flatnonzero(found.place >= size - 1)


def part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    """Partitions are ranges of hashes: ascending hashes have ascending partitions."""
    return ((gram >> U64(32)) * U64(parts)) >> U64(32)


def chunked(texts: DataFrame, settings: Settings) -> DataFrame:
    """Rows of (doc_id, text) gathered into chunks of about ``chunk_bytes``, each a compressed table."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = number = 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(
                sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
            ) as out:
                out.write_table(table)
            raw = sink.getvalue().to_pybytes()
            return columns_of([(base + number, size, raw)], CHUNKS)

        for batch in batches:
            for part in released(slices(batch, "text", settings.chunk_bytes)):
                held.append(part)
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= settings.chunk_bytes:
                    yield packed().to_batches()[0]
                    held, size, number = [], 0, number + 1
        if held:
            yield packed().to_batches()[0]

    return texts.mapInArrow(gather, CHUNKS)


def opened(table: pa.Table) -> tuple[pa.Array, Words]:
    """The ``doc_id`` and the words of a chunk."""
    docs = pa.ipc.open_stream(table.column("docs")[0].as_py()).read_all().combine_chunks()
    text = docs.column("text").combine_chunks()
    ids = docs.column("doc_id").combine_chunks()
    return ids, hashed_words(text, pc.ascii_split_whitespace)


def grams_at(found: Words, size: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams that end at these positions. Size 0 has one n-gram, the empty one, for each
    word: its count is the number of all words."""
    if size == 0:
        return np.zeros(len(at), U64)
    return rolled(found.word, size)[at - size + 1]


def counts_at(found: Words, counted: pa.Table | None) -> dict[int, np.ndarray]:
    """The count of the n-gram of each size that ends at each word, from what came back."""
    rows: dict[int, list[tuple[int, bytes]]] = {}
    if counted is not None:
        for size, part, raw in zip(
            *(counted.column(c).to_pylist() for c in ("size", "part", "counts")), strict=True
        ):
            rows.setdefault(size, []).append((part, raw))
    counts: dict[int, np.ndarray] = {}
    for size in sorted(rows):
        sums = np.concatenate([unshuffled(raw, np.int64) for _, raw in sorted(rows.pop(size))])
        at = ends(found, size)
        own = 0
        if size:
            _, own = np.unique(grams_at(found, size, at), return_inverse=True)
        counts[size] = np.zeros(len(found.word), np.int64)
        counts[size][at] = sums[own]
    return counts


def exploded(found: Words, chunk: int, size: int, parts: int) -> pa.Table:
    """The distinct n-grams of a size in a chunk, a row for each partition that counts some of them."""
    rows = []
    gram, count = np.unique(grams_at(found, size, ends(found, size)), return_counts=True)
    edges = np.searchsorted(part_of(gram, parts), np.arange(parts + 1).astype(U64))
    for part in np.flatnonzero(np.diff(edges)).tolist():
        own = slice(edges[part], edges[part + 1])
        steps = np.diff(gram[own], prepend=U64(0))
        rows.append((size, part, chunk, shuffled(steps), shuffled(count[own].astype(np.int64))))
    return columns_of(rows, GRAMS)


def added_up(table: pa.Table) -> pa.Table:
    """What goes back to the chunks from one partition of a count table."""
    size, part = table.column("size")[0].as_py(), table.column("part")[0].as_py()
    lists = [
        np.cumsum(unshuffled(raw, U64), dtype=U64) for raw in table.column("grams").to_pylist()
    ]
    counts = [unshuffled(raw, np.int64) for raw in table.column("counts").to_pylist()]
    known, own = np.unique(np.concatenate(lists), return_inverse=True)
    # Exact: no sum comes near the 53 bits of a double.
    sums = np.bincount(own, weights=np.concatenate(counts)).astype(np.int64)
    bounds = np.cumsum([0, *map(len, lists)])
    back = [shuffled(sums[own[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    chunks = table.column("chunk").to_pylist()
    return columns_of([(size, part, c, raw) for c, raw in zip(chunks, back, strict=True)], FOUND)


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_tokens, log_score, mean_log_score): a row per row of ``docs``."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    chunks = store(chunked(texts, settings), "chunks").table
    total = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    parts = tasks_for(docs, total, settings.part_bytes)

    def counted(sizes: Sequence[int]) -> DataFrame:
        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    table = pa.Table.from_batches([batch.slice(k, 1)])
                    _, found = opened(table)
                    for size in sizes:
                        yield from exploded(found, table.column("chunk")[0].as_py(), size, parts).to_batches()

        sent = chunks.mapInArrow(explode, GRAMS)
        returned = sent.groupBy("size", "part").applyInArrow(added_up, FOUND)
        return store(returned, "ngram-counts").table

    known = counted(range(min(2, settings.order) + 1))
    for size in range(3, settings.order + 1):
        known = known.unionByName(counted([size]))

    def score(table: pa.Table, back: pa.Table) -> pa.Table:
        ids, found = opened(table)
        logs = log_scores(counts_at(found, back), found, settings)
        sums = np.bincount(found.text, weights=logs, minlength=len(found.count)).astype(float)
        means = sums / np.maximum(found.count, 1)
        return pa.table(
            {
                "doc_id": ids,
                "n_tokens": pa.array(found.count.astype(np.int64)),
                "log_score": pa.array(sums),
                "mean_log_score": pa.array(means, mask=found.count == 0),
            }
        )

    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, SCORES)


def log_scores(counts: dict[int, np.ndarray], found: Words, settings: Settings) -> np.ndarray:
    """``ln S`` of each word, from the counts of the n-grams of each size that end there."""
    if not len(found.word):
        return np.zeros(0)
    made = np.log(counts[1]) - np.log(counts[0])
    for size in range(2, settings.order + 1):
        if size not in counts:  # no n-gram of this size anywhere
            counts[size] = np.zeros(len(found.word), np.int64)
        before = np.concatenate([[0], counts[size - 1][:-1]])  # of the n-gram without its last word
        seen = (counts[size] > 0) & (found.place >= size - 1)
        backed = made + log(settings.backoff) * (found.place >= size - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            made = np.where(seen, np.log(counts[size]) - np.log(before), backed)
    return made


def columns_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.table(
        {name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)}
    )
