"""Removal of repeated passages: every window of ``width`` consecutive words whose word sequence also
starts earlier.

Each window has a Rabin-Karp hash of 64 bits: a polynomial of the hashes of its words, from prefix sums,
so that its cost does not depend on the width. Windows with equal hashes count as equal (of n distinct
windows, two are confused with a chance of about n**2 / 2**65). Spark counts them: a task first reduces a
chunk of texts to the least document of each hash, so a passage that every document has sends one row a
chunk. The rows are dealt and sorted by hash, and a pass over each partition sends all but the least
document's row of each hash. It carries one row at a time, so a hot window needs no memory. What is found
goes back to its document, one list a document, where the words that repeated windows cover merge into
maximal intervals and go.

"Earlier" is by ``doc_id``, then by the fingerprint of the text (``spans.mark``), then by start. Rows
without a ``doc_id`` come before all others. Copies of a row (equal ``doc_id`` and text) are one document
and get the same result. Null, empty and blank texts, and those of fewer words than a window, lose
nothing. Windows are judged on the input, not on what is left. Only ``doc_id`` and ``text`` are read;
other columns are returned as they are, whatever their names, and a column of that name of the caller
makes a new one longer by an underscore. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pubweave.llm.common import column, columns, fresh, ship, store, tasks_for
from pubweave.llm.hashing import MIX, U64, hashed_words, released, slices, spread
from pubweave.llm.spans import KEY, Split, cleaned, covered, flat_lists, joined, keyed

WIDTH = 20
#: Text for a chunk and for a partition of the windows.
CHUNK_BYTES = 4 << 20
PART_BYTES = 8 << 20

#: A window and the least document of its chunk that has it; or, with ``first``, a run of windows, by
#: their starts, of which a document of the same chunk has an earlier copy.
WINDOWS = "window long, doc_id long, mark long, first int, last int"
_BASE = MIX[0]
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    found = np.full(count, base, U64)
    found[:1] = 1
    return np.multiply.accumulate(found)


def window_hashes(word: np.ndarray, width: int) -> np.ndarray:
    """The Rabin-Karp hash of each run of ``width`` words, at its first word, from prefix sums."""
    count = len(word) - width + 1
    if count <= 0:
        return np.zeros(0, U64)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(word * powers(_BASE, len(word)), dtype=U64)])
    return spread((sums[width:] - sums[:-width]) * powers(_INVERSE, count))


def windows_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and start of each window."""
    found = hashed_words(texts, pc.ascii_split_whitespace)
    hashes = window_hashes(found.word, width)
    own = np.flatnonzero(found.place[: len(hashes)] <= found.count[found.text[: len(hashes)]] - width)
    return hashes[own], found.text[own], found.place[own]


def doc_keys(docs: pa.RecordBatch) -> list[np.ndarray]:
    """What documents are ordered by: whether they have an id, the id, the mark."""
    ids = docs.column("doc_id")
    known = pc.is_valid(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    plain = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    return [known, plain, docs.column("mark").to_numpy().astype(np.int64)]


def doc_order(docs: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The rows of documents in their order, rows without an id first, and the rank of each row in that
    order; copies share a rank."""
    keys = np.stack(doc_keys(docs))
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    return order, np.cumsum(np.concatenate([[0], (keys[:, 1:] != keys[:, :-1]).any(0)]))


def first_copies(hashes: np.ndarray) -> np.ndarray:
    """For each position that of the first equal hash."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    found = np.empty(len(order), np.int64)
    found[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return found


def chunk_windows(docs: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """The rows of a chunk, as in ``WINDOWS``."""
    order, rank = doc_order(docs)
    docs = docs.take(pa.array(order))
    hashes, text, start = windows_of(docs.column("text"), width)
    lead = first_copies(hashes)
    sent = np.flatnonzero(lead == np.arange(len(lead)))
    late = np.flatnonzero((rank[text] != rank[text[lead]]) | (start != start[lead]))
    cut = (np.diff(text[late]) != 0) | (np.diff(start[late]) != 1)
    heads = late[np.concatenate([[True], cut])[: len(late)]]
    tails = late[np.concatenate([cut, [True]])[: len(late)]]
    rows = np.concatenate([sent, heads])
    single = np.arange(len(rows)) < len(sent)
    owner = pa.array(text[rows])
    ends = np.concatenate([start[sent], start[tails]])
    return pa.record_batch(
        [
            pa.array(hashes[rows].view(np.int64)),
            docs.column("doc_id").take(owner),
            docs.column("mark").take(owner),
            pa.array(start[rows].astype(np.int32), mask=single),
            pa.array(ends.astype(np.int32), mask=single),
        ],
        ["window", "doc_id", "mark", "first", "last"],
    )


def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by window: all but the least document's of each window, and all runs.

    The least row so far of the window at hand is carried on; a row that beats it sends it out."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        run = pc.is_valid(batch.column("first"))
        yield batch.filter(run)
        batch = batch.filter(pc.invert(run))
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        window = batch.column("window").to_numpy()
        if not len(window):
            continue
        new = np.concatenate([[True], window[1:] != window[:-1]])
        shared = np.flatnonzero(~new | ~np.append(new[1:], True))
        keys = np.stack(doc_keys(batch))[:, shared]
        group = np.cumsum(new)[shared]
        order = np.lexsort([*keys[::-1], group])
        keys, group = keys[:, order], group[order]
        lead = np.searchsorted(group, group)
        yield batch.take(pa.array(shared[order][(keys != keys[:, lead]).any(0)]))
        least = len(window) - 1
        if len(group) and not new[least]:
            least = shared[order][lead[-1]]
        held = batch.slice(least, 1)


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row for each document that has windows that start earlier elsewhere: ``doc_id``, ``mark``, and
    ``repeats``: ``windows``, hashes of such windows, and ``runs``, first and last starts of runs of them."""
    ship(docs.sparkSession)
    texts = keyed(docs)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in released(slices(batch, "text", CHUNK_BYTES)):
                yield chunk_windows(chunk, width)

    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    dealt = texts.mapInArrow(reduce, WINDOWS).repartition(tasks_for(docs, size, PART_BYTES), "window")
    found = store(dealt.sortWithinPartitions("window").mapInArrow(later, WINDOWS), "windows").table
    lists = found.groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("first").isNull(), F.col("window"))).alias("windows"),
        F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "last"))).alias("runs"),
    )
    return store(lists.select(*KEY, F.struct("windows", "runs").alias("repeats")), "repeats").table


def repeated_words(width: int) -> Callable[[Split, pa.Array, pa.Array], np.ndarray]:
    """The words that repeated windows cover."""

    def find(found: Split, texts: pa.Array, repeats: pa.Array) -> np.ndarray:
        gone = pc.is_valid(repeats).to_numpy(zero_copy_only=False)
        if not gone.any():
            return np.zeros(len(found.text), bool)
        owner, windows = flat_lists(repeats.field("windows"))
        hashes, text, start = windows_of(texts, width)
        # A window of a text is named by both, mixed: it has to be in the list of that very text.
        name = lambda w, t: spread(w ^ spread(t.astype(U64) + U64(1)))
        known = np.isin(name(hashes, text), name(windows.to_numpy().view(U64), owner)) & gone[text]
        run_owner, runs = flat_lists(repeats.field("runs"))
        first, last = (runs.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        return covered(
            found,
            np.concatenate([text[known], run_owner]),
            np.concatenate([start[known], first]),
            np.concatenate([start[known], last]) + width,
        )

    return find


def drop_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every row with ``cleaned``: ``n_words``, ``n_removed``, and ``kept``, its words that no repeated
    window covers, joined by one space."""
    both, repeats = joined(docs, repeated_windows(docs, width), "repeats")
    out = fresh(docs, "cleaned")
    made = cleaned(column("text").cast("string"), column(repeats), repeated_words(width))
    return both.withColumn(out, made).select(*columns(docs), column(out))
