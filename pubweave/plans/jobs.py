"""The work from saved pages to result tables, as four jobs over stored article sets.

Each job reads one stored set and writes another, so a job that is run again after a failure
starts from complete input. Nothing but scalars and topic names reaches the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pubweave import sources
from pubweave.operators import (
    clean,
    countries,
    enrich,
    extract,
    ingest,
    keywords,
    pagerank,
    topics,
)
from pubweave.schema import ARTICLE
from pubweave.storage import store

# The names of the result tables. The year table is Year x topic.
COUNTRY_TABLE = "country_per_topic"
YEAR_TABLE = "country_per_year"
KEYWORD_TABLE = "most_repeated_keywords"
AUTHOR_TABLE = "top_50_influential_authors"


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return sources.read_keyed(spark, root, ARTICLE)


def collect(
    spark: SparkSession,
    root: str,
    listing_pages: DataFrame,
    article_pages: DataFrame,
    topic: str,
    website: str,
    run_date: dt.date,
) -> tuple[DataFrame, DataFrame]:
    """Add the articles of saved pages to the set under ``root``: ``(report, rejects)``.

    Of the listed items those without a stored DOI are looked up, and of the saved article pages only
    the last copies of their pages are read, once. Of records with the same DOI the last one is kept:
    the later listing page, then the later item. Only the buckets of the new DOIs are read and rewritten.

    The report says how many items were listed, how many of them were known, how many records went to the
    rejects, how many were added, and how many the set now has. The writes themselves count, in the tasks
    whose output is kept.
    """
    known = sources.read_buckets_of
    is_item = F.col("position").isNotNull()
    listing, looked_up, lost = Observation(), Observation(), Observation()
    listed = extract.extracted_listing(listing_pages).observe(
        listing,
        F.count_if(is_item).alias("found"),
        F.count_if(is_item & F.col("reason").isNull()).alias("read"),
    )
    listed = store(listed, "listed").table
    records = extract.records_of(listed)
    new_items = ingest.new_only(records, known(records, root, ARTICLE))
    items = store(new_items.observe(looked_up, F.count(F.lit(1)).alias("new")), "items").table
    links = items.select(F.col("doi").alias("_link")).distinct()
    wanted = article_pages.join(links, F.col("url") == F.col("_link"), "left_semi")
    pages = store(
        extract.extracted_article_pages(extract.latest_page(wanted)), "article-fields"
    ).table
    built, unmatched = extract.build_articles(
        items, extract.records_of(pages).drop("position"), topic, website, run_date
    )
    built = store(built, "articles").table
    rejected = ingest.union_all(extract.rejects_of(listed), extract.rejects_of(pages), unmatched)
    rejects = store(rejected.observe(lost, F.count(F.lit(1)).alias("rejected")), "rejects").table
    new = built.select(*ARTICLE.names, F.struct("page_id", "position").alias("seq"))
    done = sources.upsert(new, root, ARTICLE)
    counts = listing.get | looked_up.get | lost.get
    report = spark.createDataFrame(
        [(counts["found"], counts["read"] - counts["new"], counts["rejected"], done.after - done.before, done.after)],
        "found long, known long, rejected long, inserted long, total long",
    )
    return report, rejects


def add_quartiles(
    spark: SparkSession, root: str, ranking_pages: DataFrame, target_root: str
) -> DataFrame:
    """Complete the articles under ``root`` and merge them into the set under ``target_root``.

    Of several saved copies of a ranking page the last one counts. Articles without a DOI all stay.
    """
    journals = extract.latest_page(ranking_pages, "journal")
    enriched = enrich.enrich_quartile(_stored(spark, root), extract.extract_rankings(journals))
    # Equal keys within a set have no order of their own; the record itself decides.
    ordered = enriched.select(*ARTICLE.names).selectExpr("*", "xxhash64(to_json(struct(*))) as seq")
    sources.upsert(ordered, target_root, ARTICLE, keep_unkeyed=True)
    return _stored(spark, target_root)


def load(new: DataFrame, path: str) -> DataFrame:
    """Append the articles whose DOI the store under ``path`` lacks; the report of the run."""
    spark = new.sparkSession
    stored = sources.read_articles(spark, path, schema=new.schema)
    report = store(ingest.ingest_report(stored, new), "report").table
    sources.append_articles(ingest.new_only(new, stored, null_safe=True), path)
    return report


def analyse(articles: DataFrame, out: str) -> None:
    """Write the four result tables. Each reads only its own columns of the stored articles."""
    articles = clean.clean_articles(articles)
    ranks = pagerank.author_pagerank(articles)
    single = {
        COUNTRY_TABLE: countries.country_topic_pivot(articles),
        YEAR_TABLE: topics.year_topic_pivot(articles),
        AUTHOR_TABLE: pagerank.top_authors(ranks),
    }
    for name, table in single.items():
        sources.write_csv(table, f"{out}/{name}", single_file=True)
    sources.write_csv(keywords.keyword_counts(articles), f"{out}/{KEYWORD_TABLE}")
