"""The registered queries: every operator over whole tables.

Lists and nested values are shown as joined text, and every computed column has the name its oracle
gives it. Results are compared without order, so ranked ones carry their rank.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pubweave import sources
from pubweave.functions import (
    leading_number,
    metric_long,
    parse_day_month_year,
    publication_date_parts,
    strip,
)
from pubweave.operators import (
    cited,
    clean,
    coauthors,
    countries,
    enrich,
    extract,
    ingest,
    keywords,
    pagerank,
    topics,
)
from pubweave.operators.markup import Selector
from pubweave.plans import derived
from pubweave.storage import work_path

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = dt.date.fromisoformat(derived.RUN_DATE)
RANK_DIGITS = 6


def _joined(name: str):
    return F.array_join(name, "|").alias(name)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_articles(derived.raw_articles(spark, sf_dir))


# -- cleaning and projections


def clean_numeric(spark, sf_dir):
    return articles(spark, sf_dir).select("seq", "Day", "Year", "Downloads")


def clean_locations(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "seq", F.size("locations").alias("n"), F.get("locations", F.lit(0)).alias("first")
    )


def article_dates(spark, sf_dir):
    raw = derived.raw_articles(spark, sf_dir)
    date = parse_day_month_year(F.col("published"), RUN_DATE)
    parts = publication_date_parts(date)
    return raw.select("seq", *[c.alias(f"{n}_part") for n, c in parts.items()])


def metric_parse(spark, sf_dir):
    return derived.raw_articles(spark, sf_dir).select(
        "seq",
        metric_long(F.col("Downloads")).alias("downloads_value"),
        metric_long(F.col("citations")).alias("citations_value"),
        leading_number(F.col("citations")).alias("citations_prefix"),
    )


def _with_publisher(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "title": strip(F.concat_ws(" ", "main_title", "sub_title")),
            "publisher": F.when(
                F.col("seq") % 90 != 0,
                F.struct(
                    F.col("journal").alias("name"),
                    F.lit("N/A").alias("ISSN"),
                    F.col("quartile").alias("Quartile"),
                ),
            ),
            "website": F.lit(derived.WEBSITE),
        }
    )


def titles_publisher(spark, sf_dir):
    return _with_publisher(derived.raw_articles(spark, sf_dir)).select(
        "seq",
        "title",
        "topic",
        "website",
        strip(F.coalesce("publisher.name", F.lit(""))).alias("journal_name"),
        strip(F.coalesce("publisher.ISSN", F.lit(""))).alias("issn"),
        F.coalesce("publisher.Quartile", F.lit("")).alias("quartile_text"),
    )


def affiliations(spark, sf_dir):
    section = F.transform(
        "affiliations",
        lambda a, i: F.struct(F.concat(F.lit("Author "), i).alias("author"), a.alias("affiliation")),
    )
    raw = derived.raw_articles(spark, sf_dir).select("seq", section.alias("sections"))
    split = extract.extract_affiliations(raw)
    return split.select(
        "seq",
        _joined("universities"),
        _joined("countries"),
        F.array_join("authors_with_affiliations.author", "|").alias("names"),
        F.array_join("authors_with_affiliations.location", "|").alias("locations"),
    )


# -- topics, countries, keywords, citations


def year_topics(spark, sf_dir):
    return topics.year_topics(articles(spark, sf_dir))


def year_topic_counts(spark, sf_dir):
    return topics.year_topic_counts(articles(spark, sf_dir))


def year_topic_pivot(spark, sf_dir):
    return topics.year_topic_pivot(articles(spark, sf_dir))


def sparse_topic_pivot(spark, sf_dir):
    """Every sub-title of an order as a topic: a pivot whose topics grow with the table."""
    named = articles(spark, sf_dir).withColumn("topic", F.concat_ws(" ", "topic", "main_title"))
    pivot = topics.sparse_pivot(topics.year_topic_counts(named), "Year")
    return topics.long_form(pivot, "Year")


def country_topic_counts(spark, sf_dir):
    return countries.country_topic_counts(articles(spark, sf_dir))


def country_topic_counts_literal(spark, sf_dir):
    return countries.country_topic_counts(articles(spark, sf_dir), literal_allowlist=True)


def country_topic_counts_distinct(spark, sf_dir):
    return countries.country_topic_counts(
        articles(spark, sf_dir), allow=None, distinct_per_article=True
    )


def country_topic_pivot(spark, sf_dir):
    return countries.country_topic_pivot(articles(spark, sf_dir))


def keyword_counts(spark, sf_dir):
    return keywords.keyword_counts(derived.doc_articles(spark, sf_dir))


def keyword_top5(spark, sf_dir):
    top = keywords.keyword_counts(derived.doc_articles(spark, sf_dir), limit=5)
    # The window sees the five rows of the top-k, not the table.
    by_count = Window.orderBy(F.desc("count"), F.asc("keyword"))
    return top.withColumn("position", F.row_number().over(by_count))


def keyword_top5_certified(spark, sf_dir):
    """The same five from hashed counters and a recount of the largest."""
    top = keywords.top_keywords(derived.doc_articles(spark, sf_dir), 5)
    by_count = Window.orderBy(F.desc("count"), F.asc("keyword"))
    return top.withColumn("position", F.row_number().over(by_count))


def _citable(spark, sf_dir):
    return _with_publisher(articles(spark, sf_dir))


def top_cited_per_year(spark, sf_dir):
    return cited.top_cited_per_year(_citable(spark, sf_dir), tie_break="seq")


def cited_by_year(spark, sf_dir):
    nested = cited.cited_by_year(cited.top_cited_per_year(_citable(spark, sf_dir), tie_break="seq"))
    return nested.select(
        "Year",
        F.size("articles").alias("n"),
        F.array_join("articles.name", "|").alias("names"),
        F.array_join("articles.title", "|").alias("titles"),
    )


# -- co-author graph


def coauthor_edges(spark, sf_dir):
    edges = coauthors.coauthor_edges(articles(spark, sf_dir))
    return edges.select("src", "dst", _joined("authors"), "Year")


def coauthor_edges_in_years(spark, sf_dir):
    edges = coauthors.coauthor_edges(articles(spark, sf_dir), years=(1997, 1998))
    return edges.groupBy("Year").agg(F.count(F.lit(1)).alias("edges"))


def coauthor_vertices(spark, sf_dir):
    return coauthors.coauthor_vertices(articles(spark, sf_dir))


def edge_vertices(spark, sf_dir):
    return coauthors.vertices(coauthors.coauthor_edges(articles(spark, sf_dir)))


def _shown(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", F.round("pagerank", RANK_DIGITS).alias("pagerank"))


def author_pagerank(spark, sf_dir):
    return _shown(pagerank.author_pagerank(articles(spark, sf_dir)))


def edge_pagerank(spark, sf_dir):
    return _shown(pagerank.pagerank(coauthors.coauthor_edges(articles(spark, sf_dir))))


def shipment_pagerank(spark, sf_dir):
    """A directed graph with parallel edges and with vertices that have no outgoing edge."""
    lines = derived.table(spark, sf_dir, "lineitem")
    edges = lines.select(
        F.concat(F.lit("S"), "l_suppkey").alias("src"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("P"), "l_partkey"))
        .otherwise(F.concat(F.lit("S"), F.floor(F.col("l_partkey") / 20)))
        .alias("dst"),
    )
    return _shown(pagerank.pagerank(edges))


def top_authors(spark, sf_dir):
    ranks = pagerank.author_pagerank(articles(spark, sf_dir))
    top = pagerank.top_authors(ranks, 50, digits=RANK_DIGITS)
    by_rank = Window.orderBy(F.desc("pagerank"), F.asc("id"))
    return top.withColumn("position", F.row_number().over(by_rank))


# -- ingest and enrichment


def _existing(spark, sf_dir):
    stored = derived.raw_articles(spark, sf_dir)
    return stored.select("doi", "seq", "topic", F.col("seq").alias("position"), F.lit(0).alias("copy"))


def _incoming(spark, sf_dir):
    """Every article again under the doubled key, so that half of them are stored already."""
    key = F.col("seq") * 2
    doi = F.when(key % 500 != 0, F.concat(F.lit(derived.DOI_PREFIX), key))
    copies = F.explode(F.when(F.col("seq") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    crawled = derived.raw_articles(spark, sf_dir)
    return crawled.select(doi.alias("doi"), "seq", "topic", copies.alias("copy")).withColumn(
        "position", F.col("seq") * 2 + F.col("copy")
    )


def new_by_doi(spark, sf_dir):
    return ingest.new_only(_incoming(spark, sf_dir), _existing(spark, sf_dir)).select(
        "doi", "seq", "copy"
    )


def insert_new_null_safe(spark, sf_dir):
    new = ingest.new_only(_incoming(spark, sf_dir), _existing(spark, sf_dir), null_safe=True)
    return new.select("doi", "seq", "copy")


def merge_keep_last(spark, sf_dir):
    merged = ingest.merge_articles(
        _existing(spark, sf_dir), _incoming(spark, sf_dir), order="position"
    )
    return merged.select(
        "doi",
        "seq",
        "copy",
        "topic",
        F.col("first_position.batch").alias("first_batch"),
        F.col("first_position.position").alias("first_position"),
    )


def upsert_touched(spark, sf_dir):
    """A bucketed set after two crawls; only the buckets of the second one's keys are rewritten."""
    root = work_path(spark, "keyed")
    shown = ("doi", "seq", "copy", "topic")
    schema = _existing(spark, sf_dir).select(*shown).schema
    sources.upsert(_existing(spark, sf_dir), root, schema, order="position", buckets=32)
    sources.upsert(_incoming(spark, sf_dir), root, schema, order="position")
    return sources.read_keyed(spark, root, schema)


def new_in_touched(spark, sf_dir):
    """New records, compared only with the buckets of a set that can hold their keys."""
    root = work_path(spark, "keyed")
    schema = _existing(spark, sf_dir).select("doi", "seq").schema
    sources.upsert(_existing(spark, sf_dir), root, schema, buckets=32)
    new = _incoming(spark, sf_dir)
    return ingest.new_only(new, sources.read_buckets_of(new, root, schema)).select("doi", "seq", "copy")


def new_by_index(spark, sf_dir):
    """New records of a crawl, compared only with the files of an appended set that may hold their keys."""
    path = work_path(spark, "articles")
    stored = _existing(spark, sf_dir).select("doi", "seq", "topic")
    sources.append_articles(stored, path)
    sources.index_files(spark, path, stored.schema)
    new = _incoming(spark, sf_dir)
    near = sources.read_files_of(new, path, stored.schema)
    return ingest.new_only(new, near, null_safe=True).select("doi", "seq", "copy")


def ingest_report(spark, sf_dir):
    return ingest.ingest_report(_existing(spark, sf_dir), _incoming(spark, sf_dir))


def quartile_asof(spark, sf_dir):
    enriched = enrich.enrich_quartile(
        _with_publisher(articles(spark, sf_dir)), derived.rankings(spark, sf_dir)
    )
    return enriched.select(
        "seq",
        "Year",
        F.col("publisher.name").alias("journal_name"),
        F.col("publisher.Quartile").alias("found_quartile"),
    )


def quartile_asof_short(spark, sf_dir):
    """Two years of look-back only."""
    enriched = enrich.enrich_quartile(
        _with_publisher(articles(spark, sf_dir)), derived.rankings(spark, sf_dir), lookback=2
    )
    return enriched.groupBy("Year", F.col("publisher.Quartile").alias("found_quartile")).count()


def quartile_asof_long(spark, sf_dir):
    """A look-back of a hundred years, by merging sorted sides."""
    enriched = enrich.enrich_quartile(
        _with_publisher(articles(spark, sf_dir)), derived.rankings(spark, sf_dir), lookback=100
    )
    return enriched.groupBy("Year", F.col("publisher.Quartile").alias("found_quartile")).count()


# -- saved pages


_PAGE_RULES = [
    extract.Rule("title", (Selector("title"),), required=True),
    extract.Rule("lang", (Selector("html"),), attribute="lang", default="N/A"),
    extract.Rule("heading", (Selector("h1"),), default="Unknown"),
    extract.Rule("subtitle", (Selector("h2"),), default=""),
]
_LINK_RULES = [
    extract.Rule("href", (Selector("a"),), attribute="href", required=True),
    extract.Rule("label", (Selector("a"),), required=True),
    extract.Rule("page_title", (Selector("title"),), page_scope=True),
]


def page_scalar_fields(spark, sf_dir):
    records, _ = extract.extract_items(derived.pages(spark, sf_dir), _PAGE_RULES)
    return records.drop("position")


def page_list_fields(spark, sf_dir):
    links = (Selector("nav"), Selector("li"), Selector("a"))
    rules = [
        extract.Rule("links", links, many=True, default="N/A"),
        extract.Rule("tables", (Selector("td"),), many=True, drop_empty=True, default="Unknown"),
    ]
    records, _ = extract.extract_items(derived.pages(spark, sf_dir), rules)
    return records.select("page_id", F.size("links").alias("n"), _joined("links"), _joined("tables"))


def page_items(spark, sf_dir):
    records, _ = extract.extract_items(derived.pages(spark, sf_dir), _LINK_RULES, Selector("li"))
    return records.drop("url")


def listing_items(spark, sf_dir):
    records, _ = extract.extract_listing(derived.listing_pages(spark, sf_dir))
    return records


def listing_items_page_heading(spark, sf_dir):
    records, _ = extract.extract_listing(derived.listing_pages(spark, sf_dir), heading_of_page=True)
    return records.select("page_id", "position", "type")


def listing_rejects(spark, sf_dir):
    _, rejects = extract.extract_listing(derived.listing_pages(spark, sf_dir))
    return rejects


def listing_bounded_items(spark, sf_dir):
    """Items whose pages hold nested elements, comments, scripts and a footer."""
    records, _ = extract.extract_listing(derived.messy_listing_pages(spark, sf_dir))
    return records


def article_page_fields(spark, sf_dir):
    return _article_fields(derived.article_pages(spark, sf_dir))


def nested_article_fields(spark, sf_dir):
    return _article_fields(derived.messy_article_pages(spark, sf_dir))


def article_page_rejects(spark, sf_dir):
    _, rejects = extract.extract_article_pages(derived.messy_article_pages(spark, sf_dir))
    return rejects.select("page_id", "url", "reason")


def _article_fields(pages):
    records, _ = extract.extract_article_pages(pages)
    return records.select(
        "url",
        "abstract",
        _joined("authors"),
        _joined("keywords"),
        "issn",
        "published",
        _joined("universities"),
        _joined("countries"),
    )


def _built(spark, sf_dir):
    items, _ = extract.extract_listing(derived.listing_pages(spark, sf_dir))
    pages, _ = extract.extract_article_pages(derived.article_pages(spark, sf_dir))
    return extract.build_articles(items, pages, "parts", derived.WEBSITE, RUN_DATE)


def page_links(spark, sf_dir):
    """Search results completed by the page they link to."""
    built, _ = _built(spark, sf_dir)
    return built.select(
        "doi",
        "title",
        "Date",
        "Year",
        "Month",
        "Day",
        "Downloads",
        "citations",
        "type",
        F.col("publisher.name").alias("publisher_name"),
        F.col("publisher.ISSN").alias("publisher_issn"),
        "topic",
        "website",
        F.size("authors").alias("n_authors"),
    )


def page_link_rejects(spark, sf_dir):
    _, rejects = _built(spark, sf_dir)
    return rejects.select("doi", "reason")


def ranking_rows(spark, sf_dir):
    return extract.extract_rankings(derived.ranking_pages(spark, sf_dir))


def ranking_rows_lenient(spark, sf_dir):
    return extract.extract_rankings(derived.ranking_pages(spark, sf_dir), strict=False)


# -- sources and sinks: write to the shared work folder, then read back


def csv_roundtrip(spark, sf_dir):
    pivot = topics.year_topic_pivot(articles(spark, sf_dir))
    path = work_path(spark, "csv")
    sources.write_csv(pivot, path, single_file=True)
    return sources.read_table_csv(spark, path, pivot.schema)


_ODD_TEXTS = """case seq % 8 when 0 then 'two\\nlines' when 1 then 'a "quote"' when 2 then 'back\\\\slash\\\\'
  when 3 then '  blanks ' when 4 then '' when 5 then null when 6 then 'a,b' else '"' end"""
_ODD_TOPICS = """case seq % 8 when 0 then null when 1 then 'null' when 2 then 'AI' when 3 then 'ai'
  when 4 then 'Year' when 5 then 'a.b' when 6 then '`x`' else '' end"""


def csv_text_roundtrip(spark, sf_dir):
    """Texts that a CSV file could lose: line feeds, quotes, backslashes, outer blanks, nothing."""
    texts = articles(spark, sf_dir).select("seq", F.expr(_ODD_TEXTS).alias("cell"))
    path = work_path(spark, "csv")
    sources.write_csv(texts, path)
    return sources.read_table_csv(spark, path, texts.schema)


def odd_topic_pivot(spark, sf_dir):
    """Topics that are missing, differ in case only, or resemble column names."""
    named = articles(spark, sf_dir).withColumn("topic", F.expr(_ODD_TOPICS))
    return topics.year_topic_pivot(named)


def _appended(spark, sf_dir, format):
    path = work_path(spark, "articles")
    named = articles(spark, sf_dir).select("seq", F.expr(_ODD_TOPICS).alias("topic"))
    sources.append_articles(named.filter("seq % 2 = 0"), path, format)
    sources.append_articles(named.filter("seq % 2 = 1"), path, format)
    return sources.read_articles(spark, path, format, named.schema)


def append_odd_topics(spark, sf_dir):
    return _appended(spark, sf_dir, "parquet")


def json_append(spark, sf_dir):
    return _appended(spark, sf_dir, "json")


def quartile_by_issn(spark, sf_dir):
    """Journals by ISSN, written in different ways, with several entries per journal and year."""
    written = F.expr("concat('ISSN ', substr(journal, 7), '-X')")
    rankings = derived.rankings(spark, sf_dir).withColumn("journal", written)
    later = rankings.withColumns({"pos": F.lit(1), "Quartile": F.lit("Q9")})
    spelled = F.expr("concat('issn', substr(trim(journal), 7), 'x')")
    known = articles(spark, sf_dir).withColumn("journal", spelled)
    issn = F.struct(F.lit("any").alias("name"), F.col("journal").alias("ISSN"), F.lit("").alias("Quartile"))
    found = enrich.enrich_quartile(
        known.withColumn("publisher", issn), rankings.unionByName(later), on="ISSN"
    )
    return found.select("seq", F.col("publisher.Quartile").alias("found_quartile"))


def quartile_merge_keeps_unkeyed(spark, sf_dir):
    """Articles without a DOI all stay when sets are merged for their quartiles."""
    merged = ingest.merge_articles(
        _existing(spark, sf_dir).select("doi", "seq", "topic"),
        _incoming(spark, sf_dir).select("doi", "seq", "topic"),
        keep_unkeyed=True,
    )
    return merged.groupBy(F.col("doi").isNull().alias("unkeyed")).agg(
        F.count("*").alias("n"), F.sum("seq").alias("seqs")
    )


def csv_as_records(spark, sf_dir):
    counts = countries.country_topic_counts(articles(spark, sf_dir))
    path = work_path(spark, "csv")
    sources.write_csv(counts, path)
    return sources.csv_records(spark, path, counts.columns)


def json_roundtrip(spark, sf_dir):
    shown = _with_publisher(articles(spark, sf_dir)).select(
        "doi", "title", "authors", "Year", "publisher", "topic"
    )
    root = work_path(spark, "json")
    sources.rewrite_articles(shown, root, "json")
    current = sources.current_version(spark, root)
    stored = sources.read_articles(spark, current, "json", shown.schema)
    # The second version is computed from the first, which it must not overwrite.
    sources.rewrite_articles(stored.withColumn("topic", F.upper("topic")), root, "json")
    newest = sources.current_version(spark, root)
    stored = sources.read_articles(spark, newest, "json", shown.schema)
    return stored.select(
        "doi",
        "title",
        _joined("authors"),
        "Year",
        F.col("publisher.Quartile").alias("quartile_text"),
        "topic",
    )


def records_roundtrip(spark, sf_dir):
    counts = topics.year_topic_counts(articles(spark, sf_dir))
    path = work_path(spark, "records")
    sources.write_records(counts, path)
    return sources.read_articles(spark, path, "json", counts.schema)


def json_array_records(spark, sf_dir):
    """A file with an array and one with a single object, read by many tasks."""
    counts = topics.year_topic_counts(articles(spark, sf_dir))
    total = counts.agg(F.lit(None).cast("int").alias("Year"), F.lit("]}, all").alias("topic"), F.sum("count").alias("count"))
    path = work_path(spark, "arrays")
    sources.write_records(counts, f"{path}/array", as_array=True)
    sources.write_records(total.coalesce(1), f"{path}/object")
    return sources.read_json_arrays(spark, f"{path}/*", counts.schema)


def collection_filtered(spark, sf_dir):
    """A collection behind a data source that is named, with a filter and columns that it takes over."""
    path = work_path(spark, "collection")
    stored = articles(spark, sf_dir).select(F.col("seq").alias("_id"), "topic", "Year", "Downloads")
    stored.write.parquet(path)
    read = sources.read_collection(spark, "parquet", {"path": path}, stored.schema)
    return read.where("Year >= 1995").select("_id", "Year")


def parquet_append(spark, sf_dir):
    path = work_path(spark, "articles")
    shown = [F.col(c) for c in ("doi", "seq", "copy", "topic")]
    schema = _existing(spark, sf_dir).select(*shown).schema
    empty = sources.read_articles(spark, path, schema=schema)
    sources.append_articles(_existing(spark, sf_dir).select(*shown).unionByName(empty), path)
    stored = sources.read_articles(spark, path, schema=schema)
    new = ingest.new_only(_incoming(spark, sf_dir), stored, null_safe=True)
    sources.append_articles(new.select(*shown), path)
    return sources.read_articles(spark, path, schema=schema).select(*shown)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_numeric,
        clean_locations,
        article_dates,
        metric_parse,
        titles_publisher,
        affiliations,
        year_topics,
        year_topic_counts,
        year_topic_pivot,
        sparse_topic_pivot,
        country_topic_counts,
        country_topic_counts_literal,
        country_topic_counts_distinct,
        country_topic_pivot,
        keyword_counts,
        keyword_top5,
        keyword_top5_certified,
        top_cited_per_year,
        cited_by_year,
        coauthor_edges,
        coauthor_edges_in_years,
        coauthor_vertices,
        edge_vertices,
        author_pagerank,
        edge_pagerank,
        shipment_pagerank,
        top_authors,
        new_by_doi,
        insert_new_null_safe,
        merge_keep_last,
        upsert_touched,
        new_in_touched,
        new_by_index,
        ingest_report,
        quartile_asof,
        quartile_asof_short,
        quartile_asof_long,
        page_scalar_fields,
        page_list_fields,
        page_items,
        listing_items,
        listing_items_page_heading,
        listing_rejects,
        listing_bounded_items,
        article_page_fields,
        nested_article_fields,
        article_page_rejects,
        page_links,
        page_link_rejects,
        ranking_rows,
        ranking_rows_lenient,
        csv_roundtrip,
        csv_as_records,
        csv_text_roundtrip,
        odd_topic_pivot,
        append_odd_topics,
        json_append,
        quartile_by_issn,
        quartile_merge_keeps_unkeyed,
        json_roundtrip,
        records_roundtrip,
        json_array_records,
        collection_filtered,
        parquet_append,
    )
}
