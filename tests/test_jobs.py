"""The four jobs on the derived pages, end to end."""

from __future__ import annotations

import csv
import datetime as dt

import pytest

from pubweave import sources
from pubweave.operators import extract
from pubweave.plans import derived, jobs
from pubweave.schema import ARTICLE

SF_DIR = "/root/testdata/sf0.001"
RUN = dt.date(2001, 12, 31)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs") / "collected")
    listing = derived.listing_pages(spark, SF_DIR)
    pages = derived.article_pages(spark, SF_DIR)
    first = jobs.collect(
        spark, root, listing.filter("page_id < 100"), pages, "parts", "example", RUN
    )
    second = jobs.collect(spark, root, listing, pages, "parts", "example", RUN)
    return root, first, second


def test_collect_adds_only_new_articles(spark, stored):
    root, (first, _), (second, rejects) = stored
    one, two = first.first(), second.first()
    assert one.inserted == one.total and one.known == 0
    assert two.inserted == two.total - one.total and two.known == one.total
    listed = extract.extracted_listing(derived.listing_pages(spark, SF_DIR))
    assert two.found == listed.count()
    # What is neither known nor added is a reject, of the listing or after the join.
    assert two.rejected == two.found - two.known - two.inserted == rejects.count()
    articles = sources.read_keyed(spark, root, ARTICLE)
    assert articles.count() == two.total == articles.select("doi").distinct().count()
    assert {r.reason for r in rejects.select("reason").distinct().collect()} == {
        "link",
        "article page",
        "citations",
    }


def test_quartiles_are_merged_once(spark, stored, tmp_path):
    root = stored[0]
    rankings = derived.ranking_pages(spark, SF_DIR).withColumn("journal", derived_journal())
    target = str(tmp_path / "ranked")
    once = jobs.add_quartiles(spark, root, rankings, target)
    again = jobs.add_quartiles(spark, root, rankings, target)
    assert once.count() == again.count() == stored[2][0].first().total
    found = again.groupBy("publisher.Quartile").count().collect()
    assert {r.Quartile for r in found} > {"", "Q1"}


def derived_journal():
    from pyspark.sql import functions as F

    return F.concat(F.element_at(F.split("journal", " "), 1), F.lit(" é"))


def test_load_twice(spark, stored, tmp_path):
    articles = sources.read_keyed(spark, stored[0], ARTICLE)
    path = str(tmp_path / "store")
    assert jobs.load(articles, path).first().inserted == articles.count()
    assert jobs.load(articles, path).first().inserted == 0
    assert sources.read_articles(spark, path).count() == articles.count()


def test_analyse_writes_four_tables(spark, stored, tmp_path):
    articles = sources.read_keyed(spark, stored[0], ARTICLE)
    jobs.analyse(articles, str(tmp_path))

    def table(name):
        lines = []
        for part in sorted((tmp_path / name).glob("part-*.csv")):
            lines += list(csv.DictReader(part.open(newline="")))
        return lines

    countries = table(jobs.COUNTRY_TABLE)
    assert [r["country"] for r in countries] == ["USA"]
    years = [int(r["Year"]) for r in table(jobs.YEAR_TABLE)]
    assert years == sorted(set(years)) and len(years) > 3
    assert sum(int(r["parts"]) for r in table(jobs.YEAR_TABLE)) == articles.count()
    counts = [int(r["count"]) for r in table(jobs.KEYWORD_TABLE)]
    assert counts == sorted(counts, reverse=True) and len(counts) > 5
    ranks = [float(r["pagerank"]) for r in table(jobs.AUTHOR_TABLE)]
    assert ranks == sorted(ranks, reverse=True) and 0 < len(ranks) <= 50
