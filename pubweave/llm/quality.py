"""Quality rules from compression bands.

A text that zstandard makes much smaller repeats itself; a text that it hardly makes smaller is noise
(keys, encoded bytes). How far ordinary prose shrinks depends on its length, so each length has limits
of its own. They are applied to the whole text and to its fixed chunks: a text whose chunks are mostly
outside their band is rejected even if the whole is inside. Counts of plain rules come with it.

Null and empty texts have no words and fail the word rule. Each row is judged by its own text alone, so
repeated rows get equal verdicts, and nothing is shuffled. A text is held whole in one task, and memory
is bounded by the longest text.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pubweave.llm.common import column, columns, fresh, ship

SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 8

VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, chunks_out double, base_failed boolean, kept boolean, reason string"
)


@dataclass(frozen=True)
class Bands:
    """Limits of ``bytes / compressed bytes`` by length in bytes.

    ``steps`` holds (least length, least ratio, greatest ratio), ascending. Very short texts have no
    least ratio: there the frame that zstandard adds weighs more than the text.
    """

    steps: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 3.0),
        (256, 1.10, 3.5),
        (1024, 1.30, 4.0),
        (4096, 1.40, 4.5),
        (65536, 1.45, 6.0),
    )
    level: int = 3
    chunk: int = 4096
    chunks_out: float = 0.5
    min_words: int = 20
    repeat_percent: int = 30

    def side(self, size: int, ratio: float) -> int:
        """-1 below the band, 1 above it, else 0."""
        _, least, most = self.steps[bisect_right(self.steps, (size, np.inf, np.inf)) - 1]
        return -1 if ratio < least else int(ratio > most)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of eight words that occur twice or more in the text."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for step, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9), (4, 0xD6E8FEB86659FD93)):
        mixed = mixed[:-step] * np.uint64(factor) + mixed[step:]
    if len(np.unique(mixed)) == count:  # equal windows have equal hashes
        return 0
    exact = ids.astype(np.int64)
    for step in (1, 2, 4):
        _, exact = np.unique(exact[:-step] * (len(words) + 1) + exact[step:], return_inverse=True)
    twice = np.flatnonzero(np.bincount(exact)[exact] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[twice] += 1
    cover[twice + WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def judge(text: str | None, bands: Bands, press: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeats = repeated_words(words)
    base_failed = (
        len(words) < bands.min_words or 100 * repeats > bands.repeat_percent * len(words)
    )
    ratio = len(raw) / len(press.compress(raw)) if raw else 0.0
    out = 0
    for start in range(0, len(raw), bands.chunk):
        piece = raw[start : start + bands.chunk]
        out += len(piece) * bool(bands.side(len(piece), len(piece) / len(press.compress(piece))))
    out = out / len(raw) if raw else 0.0
    side = bands.side(len(raw), ratio)
    reason = (
        "words" if len(words) < bands.min_words
        else "repeats" if base_failed
        else "incompressible" if side < 0
        else "repetitive" if side > 0
        else "chunks" if out > bands.chunks_out
        else None
    )
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        ratio,
        out,
        base_failed,
        reason is None,
        reason,
    )


def verdict(text: Column, bands: Bands = Bands()) -> Column:
    """The verdict on a text, as a struct of the fields in ``VERDICT``."""
    ship(SparkSession.active())
    names = [part.split()[0] for part in VERDICT.split(", ")]

    def judged(texts: pd.Series) -> pd.DataFrame:
        press = zstandard.ZstdCompressor(level=bands.level)
        return pd.DataFrame([judge(t, bands, press) for t in texts], columns=names)

    return F.pandas_udf(judged, VERDICT)(text)


def quality_verdicts(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """A row per document: ``doc_id`` and the fields of its verdict."""
    judged = docs.select("doc_id", verdict(F.col("text"), bands).alias("verdict"))
    return judged.select("doc_id", "verdict.*")


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns."""
    name = fresh(docs, "verdict")
    judged = docs.withColumn(name, verdict(column("text"), bands))
    return judged.where(column(name)["kept"]).select(columns(docs))
