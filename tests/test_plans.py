"""What the plans must look like to hold at scale."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from pubweave.operators import cited, coauthors, enrich, extract, ingest, keywords, pagerank
from pubweave.plans import derived
from pubweave.plans.catalog import QUERIES, articles
from pubweave.storage import bucketed_by, deal, shuffle_partitions, store, store_bucketed

SF_DIR = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skew_settings(spark):
    return conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
    )


HEAVY = {"author_pagerank", "edge_pagerank", "shipment_pagerank", "top_authors"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_no_python_workers_and_no_products(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert forbidden not in text


def test_counts_read_two_columns(spark):
    text = plan(QUERIES["year_topic_counts"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_top_cited_limits_before_the_shuffle(spark):
    text = plan(cited.top_cited_per_year(articles(spark, SF_DIR).withColumn("title", F.lit("t"))))
    exchange = text.index("Exchange")
    assert "WindowGroupLimit" in text[:exchange] and "Partial" in text[exchange:]


def test_top_keywords_do_not_sort_the_table(spark):
    text = plan(keywords.keyword_counts(derived.doc_articles(spark, SF_DIR), limit=5))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_edges_need_no_join(spark):
    """Small papers need the shuffle of the distinct alone; large ones are dealt out once more."""
    text = plan(coauthors.coauthor_edges(articles(spark, SF_DIR)))
    assert text.count("Exchange") == 3 and "Join" not in text


def test_a_large_paper_is_spread_over_tasks(spark, rows):
    names = [f"a{k}" for k in range(1500)]
    edges = coauthors.coauthor_edges(rows([(names, 2000)], "authors array<string>, Year int"))
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sizes = [r[1] for r in edges.select("src").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1500 * 1499 and len(sizes) > 4


def test_round_needs_no_shuffle_of_memberships(spark, rows):
    members = rows([(k % 50, f"a{k % 7}") for k in range(500)], "paper bigint, id string")
    with bucketed_by(members, "paper", 1) as stored:
        total = F.sum(F.lit(1)).over(pagerank.Window.partitionBy("paper"))
        text = plan(stored.withColumn("n", total))
        assert "Bucketed: true" in text and "Exchange" not in text
        assert stored.withColumn("n", total).filter("n <> 10").count() == 0


def copies(rows, n=6000):
    """A third of the records share one key, another third has none."""
    data = [("hot",)] * n + [(None,)] * n + [(f"k{k}",) for k in range(n)]
    df = rows(data, "doi string").repartition(12)
    return df.withColumn("pad", F.md5(F.monotonically_increasing_id().cast("string")))


@pytest.mark.parametrize("null_safe", [False, True])
def test_new_only_splits_a_hot_key(spark, rows, null_safe):
    with skew_settings(spark):
        new = store(copies(rows), "new").table
        old = rows([("k1",), ("k2",)], "doi string")
        found = ingest.new_only(new, old, null_safe=null_safe, broadcast_bytes=0)
        text = plan(found, run=True)
        assert "skew=true" in text
        assert found.count() == 17998


def test_quartiles_split_a_hot_journal(spark, rows):
    with skew_settings(spark):
        names = ["J"] * 6000 + [f"J{k}" for k in range(6000)]
        data = [(k, (n, "", None), 2000 + k % 3) for k, n in enumerate(names)]
        schema = "id int, publisher struct<name:string,ISSN:string,Quartile:string>, Year int"
        stored = store(rows(data, schema).repartition(12), "articles").table
        ranked = rows(
            [(f"J{k}", 0, "c", 2000, "Q2") for k in range(500)] + [("J", 0, "c", 1995, "Q1")],
            "journal string, pos int, category string, Year int, Quartile string",
        )
        found = enrich.enrich_quartile(stored, ranked, broadcast_bytes=0)
        assert "skew=true" in plan(found, run=True)
        assert found.filter("publisher.Quartile = 'Q1'").count() == 6000
        assert found.count() == 12000


def test_page_join_splits_a_hot_item(spark, rows):
    with skew_settings(spark):
        items = copies(rows).select(
            F.monotonically_increasing_id().alias("page_id"),
            F.lit("u").alias("url"),
            F.lit(0).alias("position"),
            "doi",
            F.lit("J").alias("publisher"),
            F.lit("t").alias("type"),
            F.lit("1").alias("downloads_text"),
            F.lit("2").alias("citations_text"),
            F.col("pad").alias("main_title"),
            F.lit("").alias("sub_title"),
        )
        html = "<section id='x'></section>"
        pages = rows([(k, f"k{k}" if k else "hot", html) for k in range(3000)], "page_id bigint, url string, html string")
        fields, _ = extract.extract_article_pages(
            pages.withColumn(
                "html",
                F.lit(
                    '<section id="abstract"><div role="paragraph">a</div></section>'
                    '<span class="core-date-published">5 March 2021</span>'
                ),
            )
        )
        built, rejects = extract.build_articles(store(items, "items").table, fields, "t", "w", extract.dt.date(2024, 1, 1))
        assert "skew=true" in plan(built, run=True)
        assert built.count() == 6000 + 2999
        assert rejects.count() == 6000 + 3001


def captured_round(monkeypatch, call):
    """The plan's text of a round while ranks are broadcast."""
    texts = []

    def capture(start, one_round, max_iter):
        texts.append(plan(one_round(F.broadcast(start.table)), run=True))
        return start.table

    monkeypatch.setattr(pagerank, "_rounds_by_broadcast", capture)
    call()
    return texts[0]


def round_in_place(monkeypatch, call):
    """The final plan of a round past the broadcast limit, and the rows of its largest bucket."""
    texts, largest = [], []

    def capture(start, one_round, max_iter, buckets):
        with shuffle_partitions(start.table.sparkSession, buckets):
            ranks = store_bucketed(start.table.repartition(buckets, "id"), "id", buckets)
            texts.append(plan(one_round(ranks.table), run=True))
        return ranks.unlist()

    def dealt(df, key, buckets):
        made = deal(df, key, buckets)
        cold = made.cold.table.groupBy(F.spark_partition_id()).count()
        largest.append((cold.agg(F.max("count")).first()[0], df.count()))
        return made

    monkeypatch.setattr(pagerank, "_rounds_in_place", capture)
    monkeypatch.setattr(pagerank, "deal", dealt)
    call()
    return texts[0][: texts[0].index("Initial Plan")], largest


def hub_articles(rows):
    """One author is in every paper, that is in a third of all memberships."""
    data = [(["hub", f"a{k}", f"b{k}"], 2000) for k in range(8000)]
    return rows(data, "authors array<string>, Year int")


def test_small_ranks_are_broadcast_and_memberships_stay(spark, rows, monkeypatch):
    articles = hub_articles(rows)
    text = captured_round(monkeypatch, lambda: pagerank.author_pagerank(articles))
    final = text[: text.index("Initial Plan")]
    # The only shuffle carries the partial sums per author.
    assert "BroadcastHashJoin" in final and final.count(" Exchange ") == 1
    assert "partial_sum" in final


def shuffles(text):
    return text.count("Exchange hashpartitioning") - text.count("ReusedExchange")


def test_a_round_in_place_shuffles_twice(spark, rows, monkeypatch):
    """Shares by paper and sums by author; a hot author and a hot paper lie apart."""
    data = [(["hub", f"a{k}", f"b{k}"], 2000) for k in range(4000)]
    data.append(([f"a{k}" for k in range(4000)], 2001))
    articles = rows(data, "authors array<string>, Year int")
    text, largest = round_in_place(monkeypatch, lambda: pagerank.author_pagerank(articles, broadcast_bytes=0))
    assert shuffles(text) <= 2 and "Bucketed: true" in text
    assert all(most < total / 5 for most, total in largest) and len(largest) == 2
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        edges = rows([("x", "y"), ("y", "x")] * 5, "src string, dst string")
        text, _ = round_in_place(monkeypatch, lambda: pagerank.pagerank(edges, broadcast_bytes=0))
    assert shuffles(text) <= 1


def test_a_hot_source_lies_apart(spark, rows, monkeypatch):
    edges = rows([("hub", f"v{k}") for k in range(8000)] + [(f"v{k}", f"v{k // 2}") for k in range(8000)], "src string, dst string")
    text, largest = round_in_place(monkeypatch, lambda: pagerank.pagerank(edges, broadcast_bytes=0))
    assert shuffles(text) <= 1 and "BroadcastHashJoin" in text
    assert all(most < total / 5 for most, total in largest)


def test_append_splits_a_hot_topic(spark, rows, tmp_path):
    from pubweave import sources

    df = copies(rows).select("doi", "pad", F.coalesce("doi", F.lit("none")).substr(1, 1).alias("topic"))
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB"):
        sources.append_articles(store(df, "new").table, str(tmp_path / "set"))
    assert len(list((tmp_path / "set" / "by_topic=h").glob("*.parquet"))) > 1


def test_merge_combines_copies_before_the_shuffle(spark, rows):
    old = copies(rows).withColumn("seq", F.monotonically_increasing_id())
    merged = ingest.merge_articles(old, old.limit(0))
    text = plan(merged)
    assert text.count("partial_max_by") == 1 and text.count("hashpartitioning") == 1
    assert merged.count() == 6002


def test_report_is_one_combined_pass(spark, rows):
    text = plan(ingest.ingest_report(copies(rows), copies(rows)))
    assert "Join" not in text and "partial_sum" in text


def test_a_collection_takes_over_filters_and_columns(spark):
    text = plan(QUERIES["collection_filtered"](spark, SF_DIR))
    assert "GreaterThanOrEqual(Year,1995)" in text and "ReadSchema: struct<_id:bigint,Year:int>" in text
