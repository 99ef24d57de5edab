"""URL filters: fixed rules first, gradient-boosted trees on lexical features for the rest.

A rule is a host with a path prefix. It fits its host and all subdomains, if the URL's path starts with
the rule's, and the longest fitting rule decides. What no rule decides is judged by trees over what can
be read off the URL itself: lengths, depth, digit ratio, entropy, counts of parameters and separators,
and statistics of the host's suffix among the labelled URLs. The trees are Spark ML's; they are trained
on at most ``Limits.labelled`` labelled URLs, taken by hash order, and each row is judged by itself: the
suffix table has at most as many rows as the sample, so it is broadcast.

Null URLs and URLs without ``://`` have an empty host and an empty path, all features of an empty text,
and are judged like others. Equal URLs get equal verdicts. Without labelled URLs of both kinds there
are no trees, and what no rule decides is allowed.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``name`` is a host and a path prefix as one text, such as ``example.com/en/``."""

    name: str
    verdict: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return self.name[len(self.host) :]


@dataclass(frozen=True)
class Limits:
    """``labelled``: the bound of the sample that trees are trained on. ``blocked``: probability from
    which the trees block."""

    labelled: int = 20_000
    trees: int = 20
    depth: int = 4
    blocked: float = 0.5
    smoothing: float = 20.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z are lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as struct (name, verdict); null if none does."""

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)

    made = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        made = F.when(
            fits(rule), F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(made)
    return made


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the letters of a text, in bits."""
    letters = F.split(text, "")
    total = F.greatest(F.size(letters), F.lit(1)).cast("double")
    shares = F.transform(
        F.array_distinct(letters),
        lambda x: (F.size(letters) - F.size(F.array_remove(letters, x))).cast("double") / total,
    )
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    length = F.length(text).cast("double")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    return {
        "f_length": length,
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_depth": _count(path, r"/[^/]"),
        "f_labels": _count(host, r"\."),
        "f_digits": _count(text, r"[0-9]") / F.greatest(length, F.lit(1.0)),
        "f_host_digits": _count(host, r"[0-9]"),
        "f_dashes": _count(host, r"-"),
        "f_entropy": _entropy(text),
        "f_host_entropy": _entropy(host),
        "f_parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "f_percent": _count(text, r"%[0-9A-Fa-f]{2}"),
        "f_secure": text.startswith("https:").cast("double"),
        "f_longest": F.array_max(
            F.transform(F.split(text, r"[^A-Za-z]+"), lambda w: F.length(w))
        ).cast("double"),
    }


def parsed(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, ``url``, ``host`` and ``path`` of each row."""
    url = F.col("url")
    return pages.select(key, "url", host_of(url).alias("host"), path_of(url).alias("path"))


@dataclass(frozen=True)
class UrlModel:
    """Trained trees with the suffix statistics they rest on."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    rate: float
    limits: Limits


def _with_features(rows: DataFrame, suffixes: DataFrame, rate: float) -> tuple[DataFrame, list[str]]:
    made = features(F.col("url"), F.col("host"), F.col("path"))
    joined = rows.withColumn("suffix", suffix_of(F.col("host"))).join(
        F.broadcast(suffixes), "suffix", "left"
    )
    columns = made | {
        "f_suffix_rate": F.coalesce("suffix_rate", F.lit(rate)),
        "f_suffix_count": F.log1p(F.coalesce("suffix_count", F.lit(0)).cast("double")),
    }
    return joined.withColumns(columns), list(columns)


def train(labelled: DataFrame, limits: Limits = Limits()) -> UrlModel:
    """A model from rows (url, label), label 1 for URLs to block.

    Rows without a label count for nothing, equal rows once. At most ``limits.labelled`` rows are used:
    those with the least hash of their URL, so that the choice depends on the data alone.
    """
    spark = labelled.sparkSession
    given = labelled.where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label"))
    chosen = given.distinct().orderBy(F.xxhash64("url"), "url", "label").limit(limits.labelled).toArrow()
    sample = spark.createDataFrame(chosen, "url string, label double")
    rows = sample.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = chosen.column("label").to_pylist()
    rate = sum(labels) / len(labels) if labels else 0.0
    counted = rows.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(
        F.count("*").alias("suffix_count"), F.sum("label").alias("bad")
    )
    suffixes = counted.select(
        "suffix",
        "suffix_count",
        ((F.col("bad") + rate * limits.smoothing) / (F.col("suffix_count") + limits.smoothing)).alias(
            "suffix_rate"
        ),
    )
    if len(set(labels)) < 2:
        return UrlModel(None, suffixes, rate, limits)
    wide, names = _with_features(rows, suffixes, rate)
    learner = GBTClassifier(
        maxIter=limits.trees, maxDepth=limits.depth, stepSize=0.3, seed=7, featuresCol="features"
    )
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(wide)
    return UrlModel(learner.fit(assembled.select("features", "label")), suffixes, rate, limits)


def filter_urls(
    pages: DataFrame, rules: tuple[Rule, ...], model: UrlModel, key: str = "page_id"
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``p_block``, the trees' probability."""
    rows = parsed(pages, key).withColumn(
        "fit", fitting_rule(F.col("host"), F.col("path"), rules)
    )
    if model.trees is None:
        scored = rows.withColumn("p_block", F.lit(0.0))
    else:
        wide, names = _with_features(rows, model.suffixes, model.rate)
        assembled = VectorAssembler(inputCols=names, outputCol="features").transform(wide)
        scored = model.trees.transform(assembled).withColumn(
            "p_block", vector_to_array("probability")[1]
        )
    own = F.when(F.col("p_block") >= model.limits.blocked, BLOCK).otherwise(ALLOW)
    return scored.select(
        key,
        "host",
        "path",
        F.col("fit.name").alias("rule"),
        F.coalesce("fit.verdict", own).alias("verdict"),
        "p_block",
    )


def rule_labels(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Labelled URLs from the rules: what they decide, as rows (url, label)."""
    rows = parsed(pages.select(F.lit(0).alias("key"), "url"), "key")
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    decided = rows.select("url", fit.alias("fit")).where("fit is not null")
    return decided.select("url", (F.col("fit.verdict") == BLOCK).cast("double").alias("label"))


def label_by_hosts(pages: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """Labelled URLs from seed words: 1 if the host holds one as a part between dots and dashes."""
    rows = parsed(pages.select(F.lit(0).alias("key"), "url"), "key")
    parts = F.split("host", r"[.\-]")
    bad = reduce(lambda a, b: a | b, (F.array_contains(parts, w) for w in words))
    return rows.select("url", bad.cast("double").alias("label"))
