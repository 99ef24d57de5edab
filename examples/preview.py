"""Look at the results on a small data set: ``python examples/preview.py [table folder]``."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pubweave.operators import (  # noqa: E402
    author_pagerank,
    clean_articles,
    country_topic_pivot,
    keyword_counts,
    top_authors,
    top_cited_per_year,
    year_topic_pivot,
    year_topics,
)
from pubweave.plans import derived  # noqa: E402
from pubweave.session import local_session  # noqa: E402


def main(folder: str) -> None:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    articles = clean_articles(derived.raw_articles(spark, folder))
    articles.printSchema()
    articles.select("doi", "Year", "topic", "authors").show()
    year_topics(articles).show()
    year_topic_pivot(articles).show()
    country_topic_pivot(articles).show()
    keyword_counts(derived.doc_articles(spark, folder), limit=5).show()
    titled = articles.withColumnRenamed("main_title", "title")
    top_cited_per_year(titled).orderBy("Year", "position").show()
    top_authors(author_pagerank(articles)).show()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
