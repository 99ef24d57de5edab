"""Affiliation countries by topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pubweave.functions import country_name
from pubweave.operators.topics import topic_pivot

# The countries reported by default.
DEFAULT_COUNTRIES = (
    "USA",
    "Canada",
    "Mexico",
    "Brazil",
    "India",
    "China",
    "Australia",
    "Germany",
    "United Kingdom",
    "France",
    "Morocco",
)


def _capitalised(name: str) -> str:
    """The driver-side twin of ``country_name``, for the short list of reported countries."""
    return " ".join(w[:1].upper() + w[1:].lower() for w in name.strip(" ").split(" "))


def affiliation_countries(
    articles: DataFrame,
    allow: Sequence[str] | None = DEFAULT_COUNTRIES,
    literal_allowlist: bool = False,
    distinct_per_article: bool = False,
) -> DataFrame:
    """``(country, topic)``, one row per country entry of an article.

    An article whose list names a country twice counts twice unless ``distinct_per_article``.
    The allow-list is compared in the normalised spelling and reported in its own, so ``USA``
    matches ``usa``; ``literal_allowlist`` compares the normalised text with the list as written.
    ``allow=None`` keeps every non-empty country.
    """
    names = F.coalesce("countries", F.array())
    if distinct_per_article:
        names = F.array_distinct(F.transform(names, country_name))
    rows = (
        articles.select("topic", F.explode(names).alias("country"))
        .filter(F.col("country").isNotNull() & (F.col("country") != ""))
        .withColumn("country", country_name(F.col("country")))
    )
    if allow is None:
        return rows.filter(F.col("country") != "").select("country", "topic")
    if literal_allowlist:
        return rows.filter(F.col("country").isin(list(allow))).select("country", "topic")
    spelling = {_capitalised(name): name for name in allow}
    respelled = {k: v for k, v in spelling.items() if k != v}
    shown = F.col("country")
    for normal, own in respelled.items():
        shown = F.when(F.col("country") == normal, F.lit(own)).otherwise(shown)
    return rows.filter(F.col("country").isin(list(spelling))).select(
        shown.alias("country"), "topic"
    )


def country_topic_counts(articles: DataFrame, **options) -> DataFrame:
    """``(country, topic, count)``; options as for ``affiliation_countries``."""
    return affiliation_countries(articles, **options).groupBy("country", "topic").count()


def country_topic_pivot(
    articles: DataFrame, topics: Sequence[str | None] | None = None, **options
) -> DataFrame:
    """Country × topic table; options as for ``affiliation_countries``."""
    return topic_pivot(country_topic_counts(articles, **options), "country", topics)
