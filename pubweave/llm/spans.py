"""Documents as sequences of words, and texts without some spans of their words.

Words are runs without ASCII separators, as written; null texts have none. A document is known by its
``doc_id`` and a fingerprint of its text (``mark``): rows that share both are copies of one document and
get the same result, rows that share a ``doc_id`` alone are told apart by the mark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pubweave.llm.common import column, columns, fresh, ship
from pubweave.llm.hashing import released, slices

KEY = ["doc_id", "mark"]
CLEANED = "struct<n_words:long,n_removed:long,kept:string>"


def mark(doc_id: Column, text: Column) -> Column:
    """A hash of the text, 0 for null: of 31 bits where a ``doc_id`` tells most rows apart, else of 63."""
    bits = F.when(doc_id.isNull(), F.lit((1 << 63) - 1)).otherwise(F.lit((1 << 31) - 1))
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text).bitwiseAND(bits)).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` and ``text`` of each row."""
    doc_id, text = column("doc_id").cast("long"), column("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), mark(doc_id, text).alias("mark"), text.alias("text"))


@dataclass(frozen=True)
class Split:
    """All words of some texts in a row, the text of each, and where each text's words start."""

    words: pa.Array
    text: np.ndarray
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def places(self) -> np.ndarray:
        """Numbers of the words in their texts, from 0."""
        return np.arange(len(self.text)) - self.starts[self.text]


def split(texts: pa.Array) -> Split:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    owner = owner[filled.to_numpy(zero_copy_only=False)]
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
    return Split(flat.filter(filled), owner, starts)


def covered(found: Split, text: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words lie in any span of words ``[first, end)`` of these texts. Spans may overlap; what
    lies beyond a text counts for nothing."""
    last = found.counts[text]
    steps = np.zeros(len(found.text) + 1, np.int64)
    np.add.at(steps, found.starts[text] + np.clip(first, 0, last), 1)
    np.add.at(steps, found.starts[text] + np.clip(end, 0, last), -1)
    return np.cumsum(steps)[:-1] > 0


def without(found: Split, removed: np.ndarray) -> pa.Array:
    """For each text the number of its words, of those removed, and the others joined by one space."""
    total = len(found.starts) - 1
    gone = np.bincount(found.text[removed], minlength=total)
    offsets = np.concatenate([[0], np.cumsum(found.counts - gone)])
    kept = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found.words.filter(pa.array(~removed)))
    joined = pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.StructArray.from_arrays(
        [pa.array(found.counts), pa.array(gone.astype(np.int64)), joined], ["n_words", "n_removed", "kept"]
    )


def flat_lists(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each item of a list column, and the items; null lists are empty."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), counts), lists.flatten()


def cleaned(
    text: Column, lists: Column, removed: Callable[[Split, pa.Array, pa.Array], np.ndarray]
) -> Column:
    """Texts without the words that ``removed`` finds, given the split texts, the texts, and ``lists``:
    a struct as in ``CLEANED``. Some megabytes of text are split at a time."""

    def run(texts: pa.Array, given: pa.Array) -> pa.Array:
        parts = []
        batch = pa.RecordBatch.from_arrays([texts, given], ["text", "lists"])
        for part in released(slices(batch, "text")):
            found = split(part.column("text"))
            parts.append(without(found, removed(found, part.column("text"), part.column("lists"))))
        return pa.concat_arrays(parts) if parts else without(split(texts), np.zeros(0, bool))

    ship(SparkSession.active())
    return F.arrow_udf(run, CLEANED)(text, lists)


def joined(docs: DataFrame, found: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with the column ``name`` of ``found``, a row per document, null where it has none. The
    second value is the column's name in the result, which may be longer.

    ``found`` is a stored table and ``docs`` a scan, so a hot document is a hot key of a plain shuffle
    join, which adaptive execution splits. It is such a join at every size, for ``found`` has no bound.
    """
    out, doc, mine = fresh(docs, name), fresh(docs, "span_doc"), fresh(docs, "span_mark")
    right = found.hint("merge").select(F.col("doc_id").alias(doc), F.col("mark").alias(mine), F.col(name).alias(out))
    doc_id, text = column("doc_id").cast("long"), column("text").cast("string")
    same = doc_id.eqNullSafe(column(doc)) & (mark(doc_id, text) == column(mine))
    both = docs.join(right, same, "left")
    return both.select(*columns(docs), column(out)), out
