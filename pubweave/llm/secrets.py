"""Secret scans: fixed patterns, and character Markov models for what they miss.

Three kinds of patterns give the base: assignments to a telling name, access keys, long hex runs. Two
character models are then trained on labelled samples, one on random strings and one on ordinary
identifiers and words: how likely is a letter after another. A long token with a letter or digit whose
log-likelihood ratio favours the random model is added; of a token that overlaps what the base has found,
each part outside of it is judged by itself.

Everything is built from DataFrame functions, row by row; only training shuffles, and only counts of
letter pairs, at most the square of the alphabet. The ordinary sample is bounded by
``Limits.ordinary_docs`` documents, taken by hash order.

Null texts count as empty. Positions are code points, ends exclusive. Equal texts give equal spans.
Positions come from the lengths of matches and of the pieces between, so a long text costs no more a
letter than a short one. An empty table of samples gives a model that adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from pubweave.llm.common import column, columns, fresh

#: Fixed patterns. The names count in either case of ASCII letters.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")
ADDED = "markov"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]"
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
BLOCK = 128


@dataclass(frozen=True)
class Limits:
    """``token``: least length of an added token. ``evidence``: least log-likelihood ratio in nats.
    ``pseudo``: added to each count of a letter pair."""

    token: int = 20
    evidence: float = 20.0
    pseudo: float = 0.5
    ordinary_docs: int = 1000


def running_sums(lengths: Column) -> Column:
    """Inclusive running sums of an array of bigints, in blocks, so that long arrays stay cheap."""
    empty = F.array().cast("array<bigint>")
    blocks = F.when(F.size(lengths) == 0, F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
            lambda k: F.slice(lengths, k * BLOCK + 1, F.lit(BLOCK)),
        )
    )

    def walk(values: Column, start: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(start.alias("at"), empty.alias("sums")),
            lambda a, v: F.struct(
                (a["at"] + v).alias("at"), F.concat(a["sums"], F.array(a["at"] + v)).alias("sums")
            ),
        )["sums"]

    zero = F.lit(0).cast("bigint")
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, v: a + v))
    starts = F.concat(F.array(zero), walk(totals, zero))
    return F.flatten(
        F.transform(blocks, lambda b, k: walk(b, F.get(starts, k)))
    )


def _matches(docs: DataFrame, text: str, name: str, pattern: str, present: Column) -> DataFrame:
    """Adds ``name``: array of struct (start, end, found) of the pattern's matches."""
    found, ends, gaps = (fresh(docs, f"{name}_{part}") for part in ("found", "ends", "gaps"))
    t = column(text)
    strings, longs = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    first = docs.withColumns(
        {
            found: F.when(present, F.regexp_extract_all(t, F.lit(pattern), 0)).otherwise(strings),
            gaps: F.when(
                present, F.transform(F.split(t, pattern, -1), lambda g: F.length(g).cast("bigint"))
            ).otherwise(longs),
        }
    )
    steps = F.zip_with(
        F.slice(column(gaps), F.lit(1), F.size(column(found))),
        column(found),
        lambda g, m: g + F.length(m),
    )
    second = first.withColumn(
        ends, F.when(F.size(column(found)) == 0, longs).otherwise(running_sums(steps))
    )
    spans = F.zip_with(
        column(ends),
        column(found),
        lambda e, m: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), m.alias("found")
        ),
    )
    return second.withColumn(name, spans).drop(found, ends, gaps)


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")
        ),
    )


def _base(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``assign``, ``access`` and ``hex``: matches that hold, with text."""
    t = column(text)
    low = fresh(docs, "low")
    docs = docs.withColumn(low, F.lower(t))
    l = column(low)  # noqa: E741
    named = (
        l.contains("passw") | l.contains("secret") | l.contains("token") | l.contains("apikey")
        | l.contains("api_key")
    )
    docs = _matches(docs, text, "assign", ASSIGN, named).drop(low)
    docs = _matches(docs, text, "access", ACCESS, t.contains("AKIA"))
    docs = _matches(docs, text, "hex", HEX, t.rlike(HEX))
    long_enough = F.filter(
        F.col("assign"), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= 6
    )
    return docs.withColumn("assign", long_enough)


@dataclass(frozen=True)
class CharModel:
    """Log-likelihood ratios random : ordinary, for each letter after each letter of the alphabet, as
    one flat list."""

    ratios: tuple[float, ...]

    def evidence(self, token: Column) -> Column:
        """The ratio of a token in nats; letters outside the alphabet break it into parts."""
        table = F.split(F.lit(" ".join(map(repr, self.ratios))), " ").cast("array<double>")
        return _pair_sum(F.transform(F.split(token, ""), _place), table)


def _place(letter: Column) -> Column:
    """1 to the alphabet's size, 0 for other letters."""
    return F.instr(F.lit(ALPHABET), letter)


def _pair_sum(places: Column, table: Column) -> Column:
    pairs = F.zip_with(
        F.slice(places, F.lit(1), F.size(places) - 1),
        F.slice(places, F.lit(2), F.size(places) - 1),
        lambda a, b: F.when((a > 0) & (b > 0), F.get(table, (a - 1) * len(ALPHABET) + b - 1)).otherwise(
            0.0
        ),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def train(samples: DataFrame, limits: Limits = Limits()) -> CharModel:
    """A model from rows (token, label), label 1 for random strings, 0 for ordinary ones.

    Letter pairs are counted on the executors; at most two times the square of the alphabet counts
    come back. Null tokens and labels count for nothing.
    """
    given = samples.where("token is not null and length(token) > 1 and label is not null")
    letters = (
        given.groupBy("label", "token")
        .agg(F.count("*").alias("n"))
        .select("label", "n", F.split("token", "").alias("letters"))
    )
    pairs = F.zip_with(
        F.slice("letters", F.lit(1), F.size("letters") - 1),
        F.slice("letters", F.lit(2), F.size("letters") - 1),
        lambda a, b: F.concat(a, b),
    )
    counted = (
        letters.select("label", "n", F.explode(pairs).alias("pair"))
        .where(F.col("pair").rlike(f"^{TOKEN}{{2}}$"))
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    size = len(ALPHABET)
    counts = {k: [[limits.pseudo] * size for _ in range(size)] for k in (0, 1)}
    for label, pair, n in counted:
        counts[int(label)][ALPHABET.index(pair[0])][ALPHABET.index(pair[1])] += n
    if len({row.label for row in counted}) < 2:
        return CharModel((0.0,) * size * size)
    return CharModel(
        tuple(
            log(random / sum(counts[1][a])) - log(counts[0][a][b] / sum(counts[0][a]))
            for a in range(size)
            for b, random in enumerate(counts[1][a])
        )
    )


def labelled_tokens(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Labelled samples from documents: what the base finds is random, all other tokens of a bounded
    set of documents are ordinary."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = (
        text.select("doc_id", F.xxhash64("doc_id").alias("by"))
        .orderBy("by")
        .limit(limits.ordinary_docs)
        .select("doc_id")
        .distinct()
    )
    found = _base(text, "text")
    random = found.where("size(assign) + size(access) + size(hex) > 0").select(
        F.explode(
            F.concat(
                F.transform("assign", lambda m: F.regexp_extract(m["found"], ASSIGN, 2)),
                F.transform("access", lambda m: m["found"]),
                F.transform("hex", lambda m: m["found"]),
            )
        ).alias("token"),
        F.lit(1).alias("label"),
    )
    # An assigned value of letters alone is as likely a word as a secret.
    random = random.where(F.col("token").rlike("[0-9]"))
    cleaned = text.join(F.broadcast(chosen), "doc_id", "left_semi").select(
        F.regexp_replace(
            F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " "
        ).alias("text")
    )
    ordinary = cleaned.select(
        F.explode(F.regexp_extract_all("text", F.lit(f"{TOKEN}{{4,}}"), 0)).alias("token"),
        F.lit(0).alias("label"),
    )
    return random.unionByName(ordinary)


def _outside(token: Column, base: Column) -> Column:
    """The parts of a token outside the base spans, as structs like the token's."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    over = F.filter(base, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))

    def part(parts: Column, start: Column, end: Column) -> Column:
        own = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.when(start < end, F.concat(parts, own)).otherwise(parts)

    gaps = F.aggregate(
        over,
        F.struct(token["start"].cast("bigint").alias("at"), none.alias("parts")),
        lambda a, b: F.struct(
            F.greatest(a["at"], b["end"]).alias("at"), part(a["parts"], a["at"], b["start"]).alias("parts")
        ),
        lambda a: part(a["parts"], a["at"], token["end"]),
    )
    return F.transform(
        gaps,
        lambda g: F.struct(
            g["start"].alias("start"),
            g["end"].alias("end"),
            F.substring(
                token["found"],
                (g["start"] - token["start"] + 1).cast("int"),
                (g["end"] - g["start"]).cast("int"),
            ).alias("found"),
        ),
    )


def find_secrets(docs: DataFrame, model: CharModel, limits: Limits = Limits()) -> DataFrame:
    """All columns of ``docs`` with one more: ``secrets``, a struct of ``base`` and ``spans``, the
    latter with what the models add, each ordered by start, then kind, as (start, kind, end)."""
    row, text = F.struct(*columns(docs)).alias("row"), F.coalesce(column("text"), F.lit(""))
    work = _base(docs.select(row, text.alias("text")), "text")
    token = rf"(?<!{TOKEN}){TOKEN}{{{limits.token},}}+"
    work = _matches(work, "text", "tokens", token, F.col("text").rlike(token))
    work = work.withColumn(
        "base",
        F.array_sort(
            F.concat(*(_spans(F.col(name), kind) for kind, name in enumerate(BASE)))
        ).cast(SPANS),
    )
    parts = F.flatten(F.transform("tokens", lambda m: _outside(m, F.col("base"))))
    work = work.withColumn("tokens", F.filter(parts, lambda m: m["found"].rlike("[A-Za-z0-9]")))
    added = F.filter("tokens", lambda m: model.evidence(m["found"]) >= limits.evidence)
    work = work.withColumn("added", F.when(F.size("tokens") == 0, F.array().cast(SPANS)).otherwise(
        _spans(added, len(BASE)).cast(SPANS)
    ))
    spans = F.array_sort(F.concat("base", "added"))
    name = fresh(docs, "secrets")
    return work.select(
        "row.*", F.struct(F.col("base").alias("base"), spans.alias("spans")).alias(name)
    )


def redact(docs: DataFrame, model: CharModel, limits: Limits = Limits(), mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span, or chain of overlapping spans, replaced by ``mark``.

    All documents and columns stay; texts without a span, null ones too, stay as they are.
    """
    found = find_secrets(docs, model, limits)
    name = found.columns[-1]
    text, spans = column("text"), column(name)["spans"]
    walked = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] >= a["at"]),
                F.concat(
                    a["parts"],
                    F.array(
                        F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                        F.lit(mark),
                    ),
                ),
            ).otherwise(a["parts"]).alias("parts"),
        ),
        lambda a: F.concat(
            F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))
        ),
    )
    changed = F.when(F.size(spans) > 0, walked).otherwise(text)
    return found.select(
        *[changed.alias(c) if c == "text" else column(c) for c in docs.columns]
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in (*BASE, ADDED)))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )
