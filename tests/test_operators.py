"""Edge cases by hand, one operator at a time."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pubweave.operators import cited, clean, coauthors, countries, enrich, ingest, keywords, topics


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_articles(rows):
    raw = rows(
        [("3.7", "x", "1,234", None), (None, "5", "12", ["a"])],
        "Year string, Day string, Downloads string, locations array<string>",
    )
    cleaned = clean.clean_articles(raw)
    assert [r.asDict() for r in cleaned.collect()] == [
        {"Year": 3, "Day": 0, "Downloads": 0, "locations": [None]},
        {"Year": 0, "Day": 5, "Downloads": 12, "locations": ["a"]},
    ]
    assert dict(cleaned.dtypes)["Year"] == "int"
    assert clean.clean_articles(raw, drop_unknown_year=True).count() == 1
    numeric = clean.clean_articles(rows([(2020, 5.9), (None, None)], "Year int, Downloads double"))
    assert numeric.collect() == [(2020, 5), (0, 0)]
    scalar = clean.clean_articles(rows([("x",)], "locations string"))
    assert scalar.first()["locations"] == ["x"]


def test_new_only(rows):
    new = rows([("a",), (None,), ("b",), ("b",)], "doi string")
    old = rows([("a",), ("a",), (None,)], "doi string")
    assert ingest.new_only(new, old, null_safe=True).collect() == [("b",), ("b",)]
    assert sorted(r.doi or "" for r in ingest.new_only(new, old).collect()) == ["", "b", "b"]
    unkeyed = rows([("a",)], "doi string")
    kept = ingest.new_only(new, unkeyed, null_safe=True).collect()
    assert sorted(r.doi or "" for r in kept) == ["", "b", "b"]
    assert ingest.new_only(new, old, null_safe=True, broadcast_bytes=0).count() == 2


def test_merge_keeps_last_at_first_position(rows):
    old = rows([("x", 1, "old"), ("y", 2, "old")], "doi string, seq int, v string")
    new = rows([("x", 1, "new"), ("z", 2, "new"), ("z", 3, "newest")], "doi string, seq int, v string")
    merged = ingest.merge_articles(old, new).orderBy("first_position")
    assert [(r.doi, r.v) for r in merged.collect()] == [("x", "new"), ("y", "old"), ("z", "newest")]


def test_merge_is_idempotent_and_unites_columns(rows):
    old = rows([("x", 1, ["a"]), (None, 2, None), (None, 3, ["b"])], "doi string, seq int, authors array<string>")
    new = rows([("x", 9, "q")], "doi string, seq int, extra string")
    once = ingest.merge_articles(old, new).drop("first_position")
    again = ingest.merge_articles(once, once).drop("first_position")
    assert once.count() == again.count() == 2
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_ingest_report(rows):
    old = rows([("a",), ("a",), (None,)], "doi string")
    new = rows([("a",), ("b",), ("b",), (None,)], "doi string")
    assert ingest.ingest_report(old, new).first().asDict() == {
        "found": 4,
        "inserted": 2,
        "total": 3,
    }
    empty = old.limit(0)
    assert tuple(ingest.ingest_report(empty, empty).first()) == (0, 0, 0)


ARTICLE = "id int, publisher struct<name:string,ISSN:string,Quartile:string>, Year int"
RANKING = "journal string, pos int, category string, Year int, Quartile string"


def test_quartiles(rows):
    articles = rows(
        [
            (1, (" J ", "", None), 2020),
            (2, ("K", "", ""), 2020),
            (3, ("L", "", None), 2020),
            (4, ("M", "", None), 2020),
            (5, ("J", "", "Q4"), 2020),
            (6, ("unknown", "", None), 2020),
            (7, None, 2020),
            (8, ("J", "", None), None),
            (9, ("J", "", None), 2017),
        ],
        ARTICLE,
    )
    rankings = rows(
        [
            ("J", 0, "c", 2020, ""),
            ("J", 1, "c", 2018, "Q2"),
            ("J", 2, "c", 2018, "Q1"),
            ("K", 0, "c", 2021, "Q1"),
            ("K", 1, "c", 2010, "Q1"),
            ("L", 0, "c", 2011, "Q3"),
            ("M ", 0, "c", 2019, "-"),
            ("M", 1, "c", 2018, "Q1"),
        ],
        RANKING,
    )
    for limit in (0, 10**6):
        enriched = enrich.enrich_quartile(articles, rankings, broadcast_bytes=limit)
        found = {r.id: r.publisher.Quartile for r in enriched.collect()}
        assert found == {1: "Q2", 2: "", 3: "Q3", 4: "-", 5: "Q4", 6: "", 7: "", 8: "", 9: ""}
        assert enriched.columns == articles.columns


def test_quartiles_by_issn(rows):
    articles = rows([(1, ("other", "123", None), 2020)], ARTICLE)
    rankings = rows([("123", 0, "c", 2020, "Q1")], RANKING)
    enriched = enrich.enrich_quartile(articles, rankings, on="ISSN")
    assert enriched.first().publisher.Quartile == "Q1"


def test_keywords(rows):
    articles = rows(
        [(["\t IoT ", None, ""],), (["IOT", "n/a"],), (None,), ([],)], "keywords array<string>"
    )
    expected = [("iot", 2), ("", 1), ("n/a", 1)]
    assert [tuple(r) for r in keywords.keyword_counts(articles).collect()] == expected
    assert [tuple(r) for r in keywords.keyword_counts(articles, limit=1).collect()] == expected[:1]
    kept = keywords.keyword_counts(articles, exclude=["", "n/a"])
    assert [tuple(r) for r in kept.collect()] == expected[:1]


def test_countries(rows):
    names = [" france ", "UNITED KINGDOM", "USA", "usa", "", None, "Unknown", " "]
    articles = rows([("t", names), ("t", None)], "topic string, countries array<string>")
    assert values(countries.country_topic_counts(articles)) == [
        ("France", "t", 1),
        ("USA", "t", 2),
        ("United Kingdom", "t", 1),
    ]
    literal = countries.country_topic_counts(articles, literal_allowlist=True)
    assert values(literal) == [("France", "t", 1), ("United Kingdom", "t", 1)]
    per_article = countries.country_topic_counts(articles, distinct_per_article=True)
    assert ("USA", "t", 1) in values(per_article)
    every = countries.country_topic_counts(articles, allow=None)
    assert [c for c, _, _ in values(every)] == ["France", "United Kingdom", "Unknown", "Usa"]
    shown = countries.country_topic_counts(articles, allow=["FRANCE"])
    assert values(shown) == [("FRANCE", "t", 1)]


def test_pivot(rows):
    articles = rows(
        [(2000, "b"), (2000, "b"), (2001, "a"), (2001, None), (0, "a")], "Year int, topic string"
    )
    wide = topics.year_topic_pivot(articles)
    assert wide.columns == ["Year", "a", "b", "null"]
    assert [tuple(r) for r in wide.collect()] == [(0, 1, 0, 0), (2000, 0, 2, 0), (2001, 1, 0, 1)]
    chosen = topics.year_topic_pivot(articles, topics=["b"])
    assert [tuple(r) for r in chosen.collect()] == [(0, 0), (2000, 2), (2001, 0)]
    cells = sum(sum(r[1:]) for r in wide.collect())
    assert cells == articles.count()
    assert topics.year_topic_pivot(articles.limit(0)).count() == 0


def test_year_topics_are_sorted(rows):
    articles = rows([(2001, "a"), (1999, "z"), (2001, "a"), (1999, "b")], "Year int, topic string")
    found = [tuple(r) for r in topics.year_topics(articles).collect()]
    assert found == [(1999, "b"), (1999, "z"), (2001, "a")]


def test_top_cited(rows):
    data = [("d", "5"), ("c", None), ("b", "NaN"), ("a", "7 cites"), ("e", "5"), ("f", "1")]
    articles = rows([(2000, d, f"t{d}", c) for d, c in data], "Year int, doi string, title string, citations string")
    top = cited.top_cited_per_year(articles).orderBy("position").collect()
    assert [(r.name, r.title) for r in top] == [
        ("Article 1", "ta"),
        ("Article 2", "td"),
        ("Article 3", "te"),
        ("Article 4", "tf"),
        ("Article 5", "tb"),
    ]
    numeric = articles.withColumn("citations", F.expr("try_cast(citations as double)"))
    assert cited.top_cited_per_year(numeric).filter("position = 1").first().title == "td"
    nested = cited.cited_by_year(cited.top_cited_per_year(articles, n=2)).first()
    assert nested.Year == 2000
    assert [a.asDict() for a in nested.articles] == [
        {"name": "Article 1", "title": "ta", "citations": 7.0},
        {"name": "Article 2", "title": "td", "citations": 5.0},
    ]


def edges(rows, *papers):
    articles = rows(list(papers), "authors array<string>, Year int")
    return coauthors.coauthor_edges(articles)


def test_coauthor_edges(rows):
    assert values(edges(rows, (["a", "b", "a"], 2000)).select("src", "dst")) == [
        ("a", "b"),
        ("b", "a"),
    ]
    assert edges(rows, (["a", "b"], 2000), (["a", "b"], 2000)).count() == 2
    assert edges(rows, (["a", "b"], 2000), (["a", "b"], 2001)).count() == 4
    assert edges(rows, (["a", "b"], 2000), (["b", "a"], 2000)).count() == 4
    assert edges(rows, (["a", None], 2000), (["a"], 2000), (None, 2000), (["a", "b"], None)).count() == 0
    found = edges(rows, (["a", "b", "c"], 2000))
    pairs = set(values(found.select("src", "dst")))
    assert pairs == {(y, x) for x, y in pairs} and len(pairs) == 6
    assert found.columns == ["src", "dst", "authors", "Year"]


def test_vertices(rows):
    articles = rows([(["a", "b"], 2000), (["solo"], 2000), (["c", "a"], 1990)], "authors array<string>, Year int")
    assert values(coauthors.coauthor_vertices(articles)) == [("a",), ("b",), ("c",)]
    assert values(coauthors.vertices(coauthors.coauthor_edges(articles))) == [("a",), ("b",), ("c",)]
    assert values(coauthors.coauthor_vertices(articles, years=(1995, 2005))) == [("a",), ("b",)]


def test_top_keywords_are_certified_or_counted(spark, rows, monkeypatch):
    skewed = [([f"k{k}"] * (200 // (k + 1)) + [None, f"rare{k}"],) for k in range(40)]
    even = [([f"k{k % 50}"],) for k in range(500)]
    for data, certain in ((skewed, True), (even, False)):
        df = rows(data, "keywords array<string>")
        expected = [tuple(r) for r in keywords.keyword_counts(df, 5).collect()]
        found = keywords.top_keywords(df, 5, counters=512, recounted=16)
        assert [tuple(r) for r in found.collect()] == expected
        with monkeypatch.context() as patch:
            full = []
            patch.setattr(keywords, "keyword_counts", lambda *a, **k: full.append(1) or df)
            keywords.top_keywords(df, 5, counters=512, recounted=16)
            assert bool(full) != certain
    assert keywords.top_keywords(rows([], "keywords array<string>"), 5).count() == 0
    some = keywords.top_keywords(rows([(["a", "b"],)], "keywords array<string>"), 5, counters=512, recounted=1)
    assert some.count() == 2


def test_the_sketch_does_not_shuffle_the_vocabulary(spark):
    words = spark.range(50_000).select(F.array(F.concat(F.lit("w"), "id"), F.lit("hot")).alias("keywords"))
    found = keywords.top_keywords(words, 1, counters=1024, recounted=8)
    assert [tuple(r) for r in found.collect()] == [("hot", 50_000)]


def test_sparse_pivot_of_many_topics(spark):
    topic = F.when(F.col("id") == 7, None).otherwise(F.concat(F.lit("t"), F.col("id") % 200_000))
    counts = spark.range(400_000).select((F.col("id") % 3).alias("Year"), topic.alias("topic"), F.col("id").alias("count"))
    pivot = topics.sparse_pivot(counts, "Year")
    assert pivot.topics.count() == 200_001
    first = pivot.topics.orderBy("number").limit(3).collect()
    assert [tuple(r) for r in first] == [(0, "t0"), (1, "t1"), (2, "t10")]
    assert pivot.topics.orderBy(F.desc("number")).first()["topic"] is None
    assert pivot.cells.agg(F.max(F.size("numbers"))).first()[0] <= topics.SPARSE_TOPICS
    back = topics.long_form(pivot, "Year").selectExpr("bit_xor(xxhash64(Year, topic, count))", "count(*)").first()
    assert tuple(back) == tuple(counts.selectExpr("bit_xor(xxhash64(Year, topic, count))", "count(*)").first())
    with pytest.raises(ValueError, match="sparse_pivot"):
        topics.topic_pivot(counts, "Year")
    assert topics.topic_pivot(counts, "Year", ["t1", None]).columns == ["Year", "t1", "null"]


@pytest.mark.parametrize("lookback", [1, 2, 7, 16, 200])
def test_merged_as_of_equals_the_listed_years(rows, lookback):
    rng = random.Random(lookback)
    rankings = rows(
        [(k, f"J{rng.randrange(6)}", rng.choice([None, *range(1900, 2030)]), rng.choice(["Q1", "Q2", "", None])) for k in range(300)],
        "pos int, journal string, Year int, Quartile string",
    )
    pairs = [(f"j{j}", y) for j in range(7) for y in range(1880, 2060)] + [(None, 2000), ("j1", None)]
    wanted = rows(pairs * 2, "journal string, Year int")
    listed = {(r.journal, r.Year): r.Quartile for r in enrich.effective_quartiles(rankings, lookback).collect()}
    merged = enrich.asof_quartiles(wanted, rankings, lookback).collect()
    assert len(merged) == len({(r.journal, r.Year) for r in merged})
    assert {(r.journal, r.Year): r.Quartile for r in merged} == {k: v for k, v in listed.items() if k in set(pairs)}
