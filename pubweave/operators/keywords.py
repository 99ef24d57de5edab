"""Keyword frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pubweave.functions import strip
from pubweave.storage import discard, store

#: Hashed counters of the sketch, and how many of them, those that count most, are counted again exactly.
COUNTERS = 1 << 18
RECOUNTED = 1 << 12


def keyword_counts(
    articles: DataFrame, limit: int | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """``(keyword, count)`` by falling count, ties by keyword.

    Keywords are lower-cased and stripped; a NULL keyword is dropped, ``''`` and ``'n/a'`` count
    like any other unless they are in ``exclude``. A ``limit`` is a top-k: each task keeps its
    best rows and only those are merged. (Exploding an expression instead of the bare column keeps
    Catalyst from filtering on the list's size first, which computes a derived list twice.)
    """
    counted = _words(articles, exclude).groupBy("keyword").count()
    counted = counted.orderBy(F.desc("count"), F.asc("keyword"))
    return counted if limit is None else counted.limit(limit)


def _words(articles: DataFrame, exclude: Sequence[str]) -> DataFrame:
    keywords = (
        articles.select(F.explode(F.coalesce("keywords", F.array())).alias("keyword"))
        .filter(F.col("keyword").isNotNull())
        .select(strip(F.lower("keyword")).alias("keyword"))
    )
    return keywords.filter(~F.col("keyword").isin(list(exclude))) if exclude else keywords


def top_keywords(
    articles: DataFrame,
    limit: int,
    exclude: Sequence[str] = (),
    counters: int = COUNTERS,
    recounted: int = RECOUNTED,
) -> DataFrame:
    """The first ``limit`` rows of ``keyword_counts``, exactly, without shuffling the vocabulary.

    Keywords are first counted in hashed counters, whose number is fixed: a counter is an upper bound for
    each of its keywords. The keywords of the ``recounted`` largest counters are then counted exactly. If the
    last of the best ``limit`` has more than the largest of the other counters, nothing else can be among
    them, and that certifies the result; otherwise all keywords are counted.
    """
    spark = articles.sparkSession
    words = _words(articles, exclude)
    own = F.pmod(F.xxhash64("keyword"), F.lit(counters)).alias("counter")
    sketch = store(words.select(own).groupBy("counter").count(), "counters")
    largest = sketch.table.orderBy(F.desc("count"), "counter")
    chosen = largest.limit(recounted)
    others = largest.offset(recounted).first()
    if others is None:  # every counter is chosen
        discard(spark, sketch.path)
        return keyword_counts(articles, limit, exclude)
    # At most ``recounted`` rows of one number.
    some = words.withColumn("counter", own).join(F.broadcast(chosen.select("counter")), "counter")
    counted = some.groupBy("keyword").count().orderBy(F.desc("count"), F.asc("keyword")).limit(limit)
    best = store(counted, "top-keywords")
    discard(spark, sketch.path)
    found = best.table.agg(F.count("*").alias("n"), F.min("count").alias("least")).first()
    if found.n == limit and found.least > others["count"]:
        return best.table.orderBy(F.desc("count"), F.asc("keyword"))
    discard(spark, best.path)
    return keyword_counts(articles, limit, exclude)
