"""Byte-level BPE by a contiguous rank array.

A word starts as its bytes. Two plain arrays hold the parts and the rank of the merge of each part with
the next one. The least rank is searched again and again, its boundary deleted, and the ranks of the two
neighbours refreshed. Words are short, so a scan of a contiguous array beats any tree; a long run of
letters goes through a heap instead, because repeated scans would cost the square of its length.

Null texts count as empty and give no tokens. Each row depends on its own text alone: repeated rows give
equal tokens, and nothing is shuffled. Vocabulary files are read on each executor from a path that is a
parameter; words already seen are remembered by each worker up to ``REMEMBERED``.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable
from functools import cache
from hashlib import sha256
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pubweave.llm.common import ship

REMEMBERED = 400_000
SHORT = 96

#: The split pattern and the byte alphabet that byte-level vocabulary files use.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
PRINTABLE = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))


def byte_of_letter() -> dict[str, int]:
    """Which byte a letter in a vocabulary file stands for: printable bytes for themselves, the others
    by the letters from U+0100 on."""
    own = [b for low, high in PRINTABLE for b in range(low, high + 1)]
    others = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Remembered(dict):
    """Word to ids, filled on first use."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> tuple[int, ...]:
        self[word] = ids = self.make(word)
        return ids


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        vocabulary = given["model"]["vocab"]
        byte = byte_of_letter()
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.token_bytes: dict[int, bytes] = {
            i: bytes(byte[x] for x in token)
            for token, i in vocabulary.items()
            if token not in self.special
        } | {i: content.encode() for content, i in self.special.items()}
        self.first = [0] * 256
        for letter, b in byte.items():
            self.first[b] = vocabulary[letter]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(given["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        self.words = regex.compile(SPLIT)
        inside = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({inside})") if inside else None
        self.known = Remembered(self.encode_word)
        self.digits = {i: str(i) for i in self.token_bytes}

    def encode_word(self, word: str) -> tuple[int, ...]:
        parts = [self.first[b] for b in word.encode("utf-8", "surrogatepass")]
        return tuple(self.scan(parts) if len(parts) <= SHORT else self.queue(parts))

    def rank(self, left: int, right: int) -> int:
        found = self.merges.get((left, right))
        return found[0] if found else NEVER

    def scan(self, parts: list[int]) -> list[int]:
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < NEVER:
            at = ranks.index(least)
            parts[at] = self.merges[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = self.rank(parts[at], parts[at + 1])
            if at:
                ranks[at - 1] = self.rank(parts[at - 1], parts[at])
        return parts

    def queue(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, for long words: a heap of (rank, place, left, right),
        where entries whose parts have changed meanwhile are skipped."""
        end = len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [
            (r, k, parts[k], parts[k + 1])
            for k in range(end - 1)
            if (r := self.rank(parts[k], parts[k + 1])) < NEVER
        ]
        heapq.heapify(heap)
        while heap:
            _, k, left, right = heapq.heappop(heap)
            n = after[k]
            if parts[k] != left or n >= end or parts[n] != right:
                continue
            parts[k], parts[n] = self.merges[left, right][1], GONE
            after[k] = n = after[n]
            if n < end:
                before[n] = k
                if (r := self.rank(parts[k], parts[n])) < NEVER:
                    heapq.heappush(heap, (r, k, parts[k], parts[n]))
            if (p := before[k]) >= 0 and (r := self.rank(parts[p], parts[k])) < NEVER:
                heapq.heappush(heap, (r, p, parts[p], parts[k]))
        return [p for p in parts if p != GONE]

    def encode(self, text: str | None) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        ids: list[int] = []
        for piece in self.marks.split(text or "") if self.marks else [text or ""]:
            if piece in self.special:
                ids.append(self.special[piece])
            else:
                words = self.words.findall(piece)
                ids.extend(chain.from_iterable(map(self.known.__getitem__, words)))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The text; ids that the vocabulary lacks stand for nothing, broken UTF-8 for U+FFFD."""
        found = map(self.token_bytes.get, ids)
        return b"".join(b for b in found if b).decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        ids = self.encode(text)
        joined = ",".join(map(self.digits.__getitem__, ids)).encode()
        decoded = self.decode(ids).encode("utf-8", "surrogatepass")
        return len(ids), sha256(joined).hexdigest(), sha256(decoded).hexdigest()


NEVER = 1 << 60
GONE = -1


@cache
def codec(path: str) -> Codec:
    """One codec a worker process and file."""
    return Codec(path)


def encode(text: Column, path: str) -> Column:
    """Token ids, ``array<int>``."""
    ship(SparkSession.active())

    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([codec(path).encode(t) for t in texts])

    return F.pandas_udf(encoded, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids; null ids give the empty text."""
    ship(SparkSession.active())

    def decoded(rows: pd.Series) -> pd.Series:
        return pd.Series([codec(path).decode([] if r is None else map(int, r)) for r in rows])

    return F.pandas_udf(decoded, "string")(ids)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """A row per document: how many tokens, the digest of their ids, the digest of the text decoded
    from them."""
    ship(docs.sparkSession)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def digested(texts: pd.Series) -> pd.DataFrame:
        own = codec(path)
        return pd.DataFrame([own.digest(t) for t in texts], columns=names)

    digest = F.pandas_udf(digested, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", digest("text").alias("made")).select("doc_id", "made.*")
