"""Declared schemas of the article collection.

Inside the engine a missing value is a real NULL. The text and zero sentinels that a
collection carries are filled in by the extraction rules and by ``clean_articles``.
"""

from __future__ import annotations

from pyspark.sql import types as T

AFFILIATION = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("university", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

PUBLISHER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("ISSN", T.StringType()),
        T.StructField("Quartile", T.StringType()),
    ]
)

ARTICLE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("authors", T.ArrayType(T.StringType())),
        T.StructField("authors_with_affiliations", T.ArrayType(AFFILIATION)),
        T.StructField("Date", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Month", T.StringType()),
        T.StructField("Day", T.IntegerType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("Downloads", T.LongType()),
        T.StructField("citations", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("publisher", PUBLISHER),
        T.StructField("universities", T.ArrayType(T.StringType())),
        T.StructField("countries", T.ArrayType(T.StringType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("topic", T.StringType()),
        T.StructField("website", T.StringType()),
    ]
)

_TEXT_IN_MERGED = {"Year", "Day", "Downloads", "citations"}

# The merged collection mixes sources, so its numbers may arrive as text.
ARTICLE_MERGED = T.StructType(
    [T.StructField("_id", T.StringType())]
    + [
        T.StructField(f.name, T.StringType()) if f.name in _TEXT_IN_MERGED else f
        for f in ARTICLE.fields
    ]
    + [T.StructField("locations", T.ArrayType(T.StringType()))]
)

RANKING = T.StructType(
    [
        T.StructField("journal", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Quartile", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
