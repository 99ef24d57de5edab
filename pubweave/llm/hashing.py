"""Words of many texts as 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

T = TypeVar("T")
U64 = np.uint64
#: Odd factors that spread bits.
MIX = (U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))


def spread(x: np.ndarray) -> np.ndarray:
    """The finalizer of a 64-bit hash."""
    x = (x ^ (x >> U64(30))) * MIX[1]
    x = (x ^ (x >> U64(27))) * MIX[2]
    return x ^ (x >> U64(31))


@dataclass(frozen=True)
class Words:
    """All words of some texts in a row: the hash of each, the number of its text, its place there from
    0; and how many words each text has."""

    word: np.ndarray
    text: np.ndarray
    place: np.ndarray
    count: np.ndarray


def hashed_words(texts: pa.Array, split: Callable[[pa.Array], pa.Array]) -> Words:
    """``split`` makes a list of words of each text; nulls have none."""
    total = len(texts)
    lists = split(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(total), np.diff(lists.offsets.to_numpy()))[filled]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
        U64,
        len(coded.dictionary),
    )
    word = known[coded.indices.to_numpy()] if len(known) else np.empty(0, U64)
    count = np.bincount(text, minlength=total)
    first = np.concatenate([[0], np.cumsum(count)])
    return Words(word, text, np.arange(len(word)) - first[text], count)


def rolled(word: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, at its first word; the last runs are cut short."""
    made = np.zeros(len(word), U64)
    for step in range(width):
        part = word[step:] if step else word
        made[: len(part)] = made[: len(part)] * MIX[0] + part
    return spread(made + U64(width))


def released(items: Iterator[T]) -> Iterator[T]:
    """The items; after each one Arrow gives memory that it no longer uses back to the system."""
    for item in items:
        yield item
        pa.default_memory_pool().release_unused()


def slices(
    batch: pa.RecordBatch, name: str, most_bytes: int = 4 << 20, most_rows: int = 1 << 15
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with bounded text, but one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy()
    ends, start, total = [], 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and (total + size > most_bytes or k - start >= most_rows):
            ends.append((start, k))
            start, total = k, 0
        total += size
    if len(sizes):
        ends.append((start, len(sizes)))
    for a, b in ends:
        yield batch.slice(a, b - a)
