"""The co-author graph.

A paper is a distinct (author list, year): two records with the same list in the same year are
one paper. The members of a paper are its distinct named authors. Each paper links every
ordered pair of its members, so two people with several papers have parallel edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


#: Papers with more members are spread over tasks before their pairs are built.
SPREAD_MEMBERS = 100


def papers(
    articles: DataFrame,
    years: tuple[int, int] | None = None,
    authors: str = "authors",
    year: str = "Year",
) -> DataFrame:
    """``(authors, Year, members)`` of the papers with at least two members.

    The distinct runs on whole author lists, before anything is exploded, and is combined
    map-side: many copies of one paper shrink to one row per task before the shuffle.
    """
    chosen = articles.select(F.col(authors).alias("authors"), F.col(year).alias("Year"))
    chosen = chosen.filter(F.col("Year").isNotNull())
    if years is not None:
        chosen = chosen.filter(F.col("Year").between(*years))
    nobody = F.array(F.lit(None).cast("string"))
    members = F.array_except("authors", nobody)  # distinct, without NULL
    return chosen.distinct().withColumn("members", members).filter(F.size("members") > 1)


def coauthor_edges(
    articles: DataFrame,
    years: tuple[int, int] | None = None,
    authors: str = "authors",
    year: str = "Year",
) -> DataFrame:
    """Directed edges ``(src, dst, authors, Year)``, both directions, one per paper and pair.

    The pairs of a paper come from the paper's own row, without a join. A large paper is first dealt
    out by its first members, so its pairs are built by many tasks; small and large papers are read
    apart, so that the former need no second shuffle. The output is quadratic in the authors of a paper by definition; ``author_pagerank`` and ``coauthor_vertices`` do not go through
    it.
    """
    found = papers(articles, years, authors, year)
    many = F.size("members") > SPREAD_MEMBERS
    first = F.explode("members")
    dealt = found.filter(many).withColumn("src", first).repartition("authors", "Year", "src")
    return (
        found.filter(~many)
        .withColumn("src", first)
        .unionByName(dealt)
        .withColumn("dst", F.explode("members"))
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst", "authors", "Year")
    )


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct end points ``(id)`` of an edge table."""
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def coauthor_vertices(
    articles: DataFrame,
    years: tuple[int, int] | None = None,
    authors: str = "authors",
    year: str = "Year",
) -> DataFrame:
    """Authors with at least one co-author, straight from the papers (no pairs are built)."""
    return papers(articles, years, authors, year).select(F.explode("members").alias("id")).distinct()
