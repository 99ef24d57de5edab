"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity; two sets of Jaccard similarity s or more must
share a word within their first few, so only these prefixes are joined. The join takes the smaller set's
index prefix and the larger set's probing prefix of the same length band, and a pair goes on only if the
lengths allow the similarity, if enough words are left after the shared position, and if parity sketches
of the sets differ in no more places than the sets may. A sketch has as many bits as its band has words,
64 at least: with fewer, most pairs of long lines would pass. What goes on is verified on the whole word
sets. Of each pair the later line, by ``doc_id`` and place, is removed.

Lines with equal word sets are one set before the join: only the first of them can stay. Lists of many
near copies are thinned beforehand: the lines that share two of the least hashes of their prefixes are
compared with the first of each of eight parts of them, and those found alike need no partner any more.
Two, because one word of a prefix is in more and more lines the larger the input is.

Rarity is a word's frequency class, by the logarithm of its hashed counter; the counters cover all
words and are a table of fixed size, whatever the input. Any order would give the same result.

Only DataFrame functions are used. Lines without a word, and rows without a ``doc_id``, always stay.
Null texts stay null. Rows that share a ``doc_id`` are at one place, where equal lines stay together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from math import log
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pubweave.llm.common import column, columns, store

PLACE = ["doc_id", "line"]
#: A word's number has its class above this bit, and the rest of its hash below.
CLASS_SHIFT = 56
#: Classes for each doubling of a word's frequency; of 2^42 words none has a class above 127.
CLASSES_A_DOUBLING = 3
#: Flags of a row of the prefix join.
SETTLED, PROBES, INDEXED = 1, 2, 4
WORD = r"[^\x20\x09-\x0D]"
#: The separators of words but for blanks and line ends.
SELDOM = "\t\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    """``counters`` of word frequencies; ``crowd``: from how many lines on a list is thinned, by
    the pairs of ``hashes`` words and against ``firsts`` lines each; ``band``: ratio of lengths in a length band;
    ``sketch_longs``: of 64 bits each, the longest sketch, a power of two; ``broadcast_bytes``: measured size up to which the places of candidates are broadcast instead of
    shuffling the lines."""

    similarity: float = 0.8
    counters: int = 1 << 18
    band: float = 2.0
    crowd: int = 8
    hashes: int = 4
    firsts: int = 8
    sketch_longs: int = 8
    broadcast_bytes: int = 64 << 20

    @property
    def ratio(self) -> tuple[int, int]:
        exact = Fraction(self.similarity).limit_denominator(1000)
        return exact.numerator, exact.denominator


def _div_up(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b)


def probing_length(n: Column, settings: Settings) -> Column:
    p, q = settings.ratio
    return n - _div_up(n * p, q) + 1


def index_length(n: Column, settings: Settings) -> Column:
    """Of a set that is joined with sets at least as large."""
    p, q = settings.ratio
    return n - _div_up(n * (2 * p), p + q) + 1


def may_share(words: Column, n: Column, m: Column, settings: Settings) -> Column:
    """Whether so many shared words are enough for sets of ``n`` and ``m``."""
    p, q = settings.ratio
    return words * (p + q) >= (n + m) * p


def band_of(n: Column, settings: Settings) -> Column:
    return F.floor(F.log(n.cast("double")) / log(settings.band)).cast("int")


def widest_band(n: Column, settings: Settings) -> Column:
    """The band of the largest sets that a set may be similar to."""
    p, q = settings.ratio
    return band_of(F.floor(n * q / p), settings)


def sketch_length(band: Column, settings: Settings) -> Column:
    """How many 64-bit numbers a sketch has in a band: a power of two."""
    bits = F.pow(F.lit(settings.band), band + 1)
    longs = F.pow(F.lit(2.0), F.ceil(F.log2(bits / 64)))
    return F.least(F.greatest(longs, F.lit(1.0)), F.lit(float(settings.sketch_longs))).cast("int")


def blanked(text: Column) -> Column:
    """The text with blanks as its only separators besides line ends: at a single character a text is split
    without a regular expression."""
    seldom = reduce(or_, (F.contains(text, F.lit(c)) for c in SELDOM))
    return F.when(seldom, F.translate(text, SELDOM, " " * len(SELDOM))).otherwise(text)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line, text): all lines, the words of each parted by blanks."""
    blank = docs.select("doc_id", blanked(F.col("text")).alias("text"))
    return blank.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def hashed_words(text: Column) -> Column:
    """The distinct words of a line of ``lines_of``, as 64-bit hashes: by these words are told apart."""
    hashes = F.transform(F.split(text, " "), lambda w: F.xxhash64(w))
    return F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit(""))))


def frequency_classes(docs: DataFrame, settings: Settings) -> Column:
    """``array<bigint>``: the class of each hashed counter, as a literal."""
    counter = F.xxhash64("word").bitwiseAND(settings.counters - 1).cast("int")
    words = F.split(F.replace(blanked(F.col("text")), F.lit("\n"), F.lit(" ")), " ")
    counted = (
        docs.select(F.explode(words).alias("word"))
        .groupBy(counter.alias("counter"))
        .count()
        .toArrow()
    )
    classes = np.zeros(settings.counters, np.uint8)
    doublings = np.log2(counted.column("count").to_numpy())
    classes[counted.column("counter").to_numpy()] = doublings * CLASSES_A_DOUBLING
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<bigint>")


def _numbered(hashed: Column, classes: Column, settings: Settings) -> Column:
    """A word's number. Every counter has a class; Spark must know it, or it sorts objects instead of numbers."""
    own = F.coalesce(classes[hashed.bitwiseAND(settings.counters - 1).cast("int")], F.lit(0).cast("long"))
    return F.shiftleft(own, CLASS_SHIFT).bitwiseOR(F.shiftrightunsigned(hashed, 64 - CLASS_SHIFT))


def _part_end(k: Column, longs: Column) -> Column:
    """The least hash beyond the first ``k`` of as many equal parts of all hashes as there are ``longs``, two
    at least."""
    return F.call_function(
        "shiftleft", (k * 2 - longs).cast("long"), F.lit(63) - F.bit_count(longs - 1).cast("int")
    )


def part_ends(longs: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), longs - 1), lambda k: _part_end(k, longs))


def spread_sketch(marked: Column, longs: Column) -> Column:
    """The parities of each part of the hashes. ``marked`` has the hashes and ``part_ends`` in order, so that
    each part is a slice."""

    def at(k: Column) -> Column:
        return F.array_position(marked, _part_end(k, longs)).cast("int")

    def part(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(at(k))
        end = F.when(k == longs - 1, F.size(marked) + 1).otherwise(at(k + 1))
        return F.slice(marked, start + 1, end - start - 1)

    return F.transform(F.sequence(F.lit(0), longs - 1), lambda k: _parity(part(k), _bit))


def line_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, line, n, prefix, sketch): the first line of each distinct word set. A word is a number that
    starts with its class; ``prefix`` holds the rarest words in order, ``sketch`` the parity sketch as long
    as the widest band wants it."""
    classes = frequency_classes(docs, settings)
    # A filter on the made words would make them twice.
    lines = lines_of(docs).where(F.col("text").rlike(WORD))
    sets = lines.select(*PLACE, hashed_words(F.col("text")).alias("hashes"))
    n, longs = F.size("hashes"), F.col("longs")
    # Columns of their own: inside the functions below they would be made again for each word.
    sets = sets.select(
        "*",
        F.sort_array(F.transform("hashes", lambda h: _numbered(h, classes, settings))).alias("words"),
        sketch_length(widest_band(n, settings), settings).alias("longs"),
    )
    marked = F.when(longs > 1, F.sort_array(F.concat("hashes", part_ends(longs))))
    sets = sets.select("*", marked.alias("marked"))
    sketch = F.when(longs == 1, F.array(_parity(F.col("hashes"), _bit))).otherwise(
        spread_sketch(F.col("marked"), longs)
    )
    described = sets.select(
        *PLACE,
        n.alias("n"),
        F.xxhash64("words").alias("set_a"),
        F.xxhash64(F.lit(7), "words").alias("set_b"),
        F.slice("words", F.lit(1), probing_length(n, settings).cast("int")).alias("prefix"),
        sketch.alias("sketch"),
    )
    return (
        described.groupBy("set_a", "set_b")
        .agg(
            F.min(F.struct(*PLACE)).alias("first"),
            *(F.first(c).alias(c) for c in ("n", "prefix", "sketch")),
        )
        .select("first.*", "n", "prefix", "sketch")
    )


def _parity(values: Column, bits: Callable[[Column], Column] = lambda v: v) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(bits(v)))


def _folded(sketch: Column, longs: Column) -> Column:
    """A sketch made shorter: that of the same words at ``longs`` numbers."""
    each = (F.size(sketch) / longs).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), longs - 1), lambda k: _parity(F.slice(sketch, k * each + 1, each))
    )
    return F.when(F.size(sketch) == longs, sketch).otherwise(parts)


def _bit(word: Column) -> Column:
    """The bit that a word's hash names."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), word.bitwiseAND(63).cast("int"))


def _alike_enough(nx: Column, ny: Column, settings: Settings) -> Column:
    """What the lengths and sketches of x and y allow, the smaller one being either. ``sketch`` is the first
    number of a sketch, ``wide`` the others, as many on both sides, or NULL."""
    p, q = settings.ratio

    def near(differ: Column) -> Column:
        return may_share(F.shiftright(nx + ny - differ, 1), nx, ny, settings)

    differ = F.bit_count(F.col("x.sketch").bitwiseXOR(F.col("y.sketch")))
    wide = differ
    for k in range(settings.sketch_longs - 1):
        both = F.get("x.wide", F.lit(k)).bitwiseXOR(F.get("y.wide", F.lit(k)))
        wide = wide + F.coalesce(F.bit_count(both), F.lit(0))
    return (
        near(differ)
        & (F.least(nx, ny) * q >= F.greatest(nx, ny) * p)
        & (F.col("x.wide").isNull() | near(wide))
    )


def _sketched(sketch: Column) -> list[Column]:
    """``sketch`` and ``wide`` of a sketch."""
    others = F.when(F.size(sketch) > 1, F.slice(sketch, F.lit(2), F.size(sketch)))
    # Not null for Spark, which would make the sketch once more to ask for that before the join.
    first = F.coalesce(F.get(sketch, F.lit(0)), F.lit(0).cast("long"))
    return [first.alias("sketch"), others.alias("wide")]


def _places(later: str, earlier: str) -> list[Column]:
    return [
        F.col(f"{side}.{c}").alias(f"{name}_{c}")
        for side, name in ((later, "later"), (earlier, "earlier"))
        for c in PLACE
    ]


def least_hashes(prefix: Column, longs: Column, settings: Settings) -> Column:
    mixed = F.sort_array(F.transform(prefix, lambda w: F.xxhash64(w, longs)))
    return F.slice(mixed, F.lit(1), F.lit(settings.hashes))


def pair_keys(least: Column, settings: Settings) -> Column:
    """Hashes of all pairs of ``least``; these themselves if there are two or one."""
    pairs = F.array(
        *(F.xxhash64(F.get(least, F.lit(i)), F.get(least, F.lit(j))) for j in range(settings.hashes) for i in range(j))
    )
    many = F.shiftright(F.size(least) * (F.size(least) - 1), 1)
    return F.when(F.size(least) < 3, least).otherwise(F.slice(pairs, F.lit(1), many))


def crowd_keys(prefix: Column, longs: Column, settings: Settings) -> Column:
    """What lines of a crowd share: two of the least hashes of their prefixes. A prefix of two words or one
    has these words, for similar short lines need not share more."""
    return pair_keys(least_hashes(prefix, longs, settings), settings)


def crowd_rows(sets: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, line, n, sketch, wide, key): a row for each crowd that a line may be in."""
    sets = sets.withColumnRenamed("sketch", "whole")
    sets = sets.withColumn("least", least_hashes(F.col("prefix"), F.size("whole"), settings))
    # Spark asks a column for elements before it explodes it, and for that would make the keys three times.
    key = F.explode(pair_keys(F.col("least"), settings)).alias("key")
    return sets.select(*PLACE, "n", *_sketched(F.col("whole")), key)


def crowd_pairs(sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of a line and the first lines of a crowd that it is in: the first of each of some parts. Lines
    whose sketches differ in length are in crowds of their own."""
    keyed = crowd_rows(sets, settings)
    crowded = store(
        keyed.groupBy("key").count().where(F.col("count") >= settings.crowd).select("key"), "crowds"
    )
    # Written, for both sides of the join below: most lines are in no crowd.
    keyed = store(keyed.join(crowded.joinable(settings.broadcast_bytes), "key"), "crowd-lines").table
    part = F.pmod(F.xxhash64(*PLACE), F.lit(settings.firsts))
    crowds = (
        keyed.groupBy("key", part.alias("part"))
        .agg(F.min(F.struct(*PLACE, "n", "sketch", "wide")).alias("first"))
        .select("key", "first.*")
    )
    joined = keyed.alias("y").join(crowds.alias("x"), "key")
    return joined.where(
        _earlier("x", "y") & _alike_enough(F.col("x.n"), F.col("y.n"), settings)
    ).select(*_places("y", "x")).distinct()


def _earlier(a: str, b: str) -> Column:
    x, y = F.col(f"{a}.doc_id"), F.col(f"{b}.doc_id")
    return (x < y) | ((x == y) & (F.col(f"{a}.line") < F.col(f"{b}.line")))


def prefix_pairs(sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs that pass all filters and whose later line isn't ``settled`` yet.

    Rows of the join carry length, position and flags in one number. A set has the rows of its probing
    prefix in its own band, where they are those of its index prefix too, and the latter in wider bands.
    """
    n, at, band, longs = F.col("n"), F.col("at"), F.col("band"), F.col("longs")
    wider = F.sequence(band_of(n, settings), widest_band(n, settings))
    own = sets.withColumn("band", F.explode(wider)).withColumns(
        {"longs": sketch_length(band, settings), "probes": band == band_of(n, settings)}
    )
    indexed = index_length(n, settings).cast("int")
    prefix = F.when(F.col("probes"), F.col("prefix")).otherwise(F.slice("prefix", F.lit(1), indexed))
    kept = [*PLACE, "n", "band", "settled", "probes"]
    own = own.select(*kept, "prefix", _folded(F.col("sketch"), longs).alias("folded"))
    own = own.select(*kept, *_sketched(F.col("folded")), F.posexplode(prefix).alias("at", "word"))
    flags = {SETTLED: F.col("settled"), PROBES: F.col("probes"), INDEXED: at < indexed}
    packed = F.shiftleft(n.cast("long"), 32).bitwiseOR(F.shiftleft(at.cast("long"), len(flags)))
    for bit, flag in flags.items():
        packed = packed.bitwiseOR(F.when(flag, bit).otherwise(0).cast("long"))
    packed = F.coalesce(packed, F.lit(0).cast("long"))  # never null, as above
    keyed = own.select(F.hash("word", "band").alias("key"), *PLACE, "sketch", "wide", packed.alias("packed"))

    def number(side: str, what: str) -> Column:
        whole = F.col(f"{side}.packed")
        if what == "n":
            return F.shiftright(whole, 32)
        return F.shiftright(whole.bitwiseAND((1 << 32) - 1), len(flags))

    def flag(side: str, bit: int) -> Column:
        return F.col(f"{side}.packed").bitwiseAND(bit)

    # Both sides are the same rows, so that these are shuffled once; a condition on one side alone would
    # be moved before the shuffle and make two of it.
    x, y = keyed.alias("x"), keyed.alias("y")
    nx, ny = number("x", "n"), number("y", "n")
    left = F.least(nx - number("x", "at"), ny - number("y", "at"))
    earlier = _earlier("x", "y")
    later_settled = F.when(earlier, flag("y", SETTLED)).otherwise(flag("x", SETTLED)) != 0
    joined = y.join(
        x,
        (F.col("x.key") == F.col("y.key"))
        & (flag("x", INDEXED) + flag("y", PROBES) == INDEXED + PROBES)
        & (nx <= ny)
        & may_share(left, nx, ny, settings)
        & _alike_enough(nx, ny, settings)
        & ~later_settled
        & ((F.col("x.doc_id") != F.col("y.doc_id")) | (F.col("x.line") != F.col("y.line"))),
    )
    return joined.select(
        *(F.when(earlier, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}")).alias(f"later_{c}") for c in PLACE),
        *(F.when(earlier, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")).alias(f"earlier_{c}") for c in PLACE),
    ).distinct()


def verified(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, line) of later lines whose word sets are similar enough to the earlier ones'."""
    p, q = settings.ratio
    pairs = store(pairs, "line-pairs").table
    ends = [pairs.select(*(F.col(f"{side}_{c}").alias(c) for c in PLACE)) for side in ("later", "earlier")]
    needed = store(ends[0].unionByName(ends[1]).distinct(), "line-places")
    if needed.size <= settings.broadcast_bytes:  # other documents need not be split
        docs = docs.join(F.broadcast(needed.table.select("doc_id").distinct()), "doc_id", "left_semi")
    found = lines_of(docs).join(needed.joinable(settings.broadcast_bytes), PLACE).select(
        *PLACE, hashed_words(F.col("text")).alias("words")
    )
    found = store(found, "line-words").table
    for side in ("later", "earlier"):
        words = found.select(*(F.col(c).alias(f"{side}_{c}") for c in PLACE), F.col("words").alias(side))
        pairs = pairs.join(words, [f"{side}_{c}" for c in PLACE])
    shared = F.size(F.array_intersect("later", "earlier"))
    total = F.size("later") + F.size("earlier")
    return (
        pairs.where(shared * (p + q) >= total * p)
        .select(*(F.col(f"later_{c}").alias(c) for c in PLACE))
        .distinct()
    )


def kept_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, kept): the numbers, from 0, of the lines with words that stay; documents without such a
    line have no row."""
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    sets = store(line_sets(texts, settings), "line-sets").table
    settled = store(verified(crowd_pairs(sets, settings), texts, settings), "settled-lines")
    marks = settled.joinable(settings.broadcast_bytes)
    marked = sets.join(marks.withColumn("settled", F.lit(True)), PLACE, "left").withColumn(
        "settled", F.coalesce("settled", F.lit(False))
    )
    removed = verified(prefix_pairs(marked, settings), texts, settings)
    removed = store(removed.unionByName(settled.table), "removed-lines")
    staying = sets.select(*PLACE).join(removed.joinable(settings.broadcast_bytes), PLACE, "left_anti")
    return staying.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("kept"))


def lines_report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_lines, n_kept, kept): of the lines with words, how many there are, how many stay, and
    which, numbered from 0 among all lines; null texts have none. Without a ``doc_id`` all stay."""
    lines = F.split("text", "\n")
    filled = F.filter(F.transform(lines, lambda t, k: F.when(t.rlike(WORD), k)), lambda k: k.isNotNull())
    none = F.array().cast("array<int>")
    own = docs.select("doc_id", F.coalesce(filled, none).alias("filled"))
    own = own.select(
        "doc_id",
        F.size("filled").cast("long").alias("n_lines"),
        F.when(F.col("doc_id").isNull(), F.col("filled")).alias("every"),
    )
    kept = F.coalesce("every", "kept", none)
    return own.join(kept_lines(docs, settings), "doc_id", "left").select(
        "doc_id", "n_lines", F.size(kept).cast("long").alias("n_kept"), kept.alias("kept")
    )


def dedup_lines(
    docs: DataFrame, settings: Settings = Settings(), drop_emptied: bool = False
) -> DataFrame:
    """``docs`` with the text that is left. With ``drop_emptied`` documents that had lines with words
    and have lost all of them go."""
    row = docs.select(F.struct(*columns(docs)).alias("row"))
    kept = kept_lines(docs.select(column("doc_id"), column("text")), settings)
    joined = row.join(kept, row["row.doc_id"] == kept["doc_id"], "left").select("row", "kept")
    split = joined.withColumn("lines", F.split("row.text", "\n"))
    wordless = F.filter(
        F.transform("lines", lambda t, k: F.when(~t.rlike(WORD), k)),
        lambda k: k.isNotNull(),
    )
    staying = F.sort_array(F.concat(wordless, F.coalesce("kept", F.array().cast("array<int>"))))
    text = F.array_join(F.transform("staying", lambda k: F.get("lines", k)), "\n")
    untouched = F.col("row.text").isNull() | F.col("row.doc_id").isNull()
    made = split.withColumn("staying", staying).select(
        "row",
        F.when(untouched, F.col("row.text")).otherwise(text).alias("left"),
        (~untouched & F.col("kept").isNull() & (F.size(wordless) < F.size("lines"))).alias("emptied"),
    )
    if drop_emptied:
        made = made.where("not emptied")
    return made.select(
        *(F.col("left").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns)
    )
