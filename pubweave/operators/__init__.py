"""The operators, each a function from DataFrames to DataFrames."""

from pubweave.operators.cited import cited_by_year, top_cited_per_year
from pubweave.operators.clean import clean_articles
from pubweave.operators.coauthors import coauthor_edges, coauthor_vertices, vertices
from pubweave.operators.countries import country_topic_counts, country_topic_pivot
from pubweave.operators.enrich import enrich_quartile
from pubweave.operators.extract import (
    Rule,
    build_articles,
    extract_affiliations,
    extract_article_pages,
    extract_items,
    extract_listing,
    extract_rankings,
)
from pubweave.operators.ingest import ingest_report, merge_articles, new_only, union_all
from pubweave.operators.keywords import keyword_counts
from pubweave.operators.pagerank import author_pagerank, top_authors
from pubweave.operators.topics import year_topic_counts, year_topic_pivot, year_topics

__all__ = [
    "Rule",
    "author_pagerank",
    "build_articles",
    "cited_by_year",
    "clean_articles",
    "coauthor_edges",
    "coauthor_vertices",
    "country_topic_counts",
    "country_topic_pivot",
    "enrich_quartile",
    "extract_affiliations",
    "extract_article_pages",
    "extract_items",
    "extract_listing",
    "extract_rankings",
    "ingest_report",
    "keyword_counts",
    "merge_articles",
    "new_only",
    "top_authors",
    "top_cited_per_year",
    "union_all",
    "vertices",
    "year_topic_counts",
    "year_topic_pivot",
    "year_topics",
]
