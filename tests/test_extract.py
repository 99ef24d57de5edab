from __future__ import annotations

import datetime as dt
import time

import pytest

from pubweave.operators import extract
from pubweave.operators.markup import Selector, of_class
from pubweave.schema import ARTICLE

RUN = dt.date(2024, 1, 2)
PAGES = "page_id bigint, url string, html string"

ITEM = """<li class="search issue-item issue-item--search clearfix">
  <div class="issue-heading">{type}</div>
  <div class="issue-item__detail x"><a href="{href}" title="{publisher}">v</a></div>
  <h5><span class="hlFld-Title"><a href="/t">{title}</a></span>{more}</h5>
</li>"""

ARTICLE_PAGE = """<html><span class="core-date-published">{date}</span>
<div class="authors"><span class="dropBlock"><a class="n" title=" Ann B " href="#">AB</a></span>
<span class="dropBlock"><a href="#" title="">x</a><a title="Bo &amp; Co">y</a></span></div>
<section id="abstract" class="s"><h2>Abstract</h2><div role="paragraph">An <i>idea</i>.</div></section>
<section property="keywords"><ol><li><a href="/k"> IoT </a></li><li><a href="/k"></a></li></ol></section>
<span class="space">1234-5678</span>{affiliations}</html>"""

PERSON = """<div class="x authInfo"><span class="auth-name">{0}</span>
<span class="auth-institution"> {1} </span></div>"""


def listing(*items):
    return "<html><h1>r</h1><ul>" + "".join(items) + "</ul></html>"


def item(href="/doi/1", publisher="J", title="T", more="", type="Article"):
    return ITEM.format(href=href, publisher=publisher, title=title, more=more, type=type)


def test_listing(rows):
    more = (
        '<span class="hlFld-SubTitle">: sub</span><span class="metric">1,234</span>'
        '<span class="citation">7</span>'
    )
    html = listing(item("/doi/1", "J &amp; K", "A <b>b</b>", more), item("https://o/doi/2"))
    records, rejects = extract.extract_listing(rows([(1, "https://s/x?q=/", html)], PAGES))
    first, second = records.orderBy("position").collect()
    assert (first.doi, first.publisher, first.main_title) == ("https://s/doi/1", "J & K", "A b")
    assert (first.sub_title, first.downloads_text, first.citations_text) == (": sub", "1,234", "7")
    assert (second.doi, second.sub_title, second.downloads_text) == ("https://o/doi/2", "", "N/A")
    assert (second.citations_text, second.type) == ("N/A", "Article")
    assert rejects.count() == 0


def test_listing_rejects_are_complete(rows):
    no_link = item().replace('href="/doi/1" ', "")
    no_title = item().replace("hlFld-Title", "other")
    html = listing(item(), no_link, no_title, item().replace("issue-heading", "none"))
    pages = rows([(1, "https://s/", html), (2, "https://s/", "<p>nothing</p>")], PAGES)
    records, rejects = extract.extract_listing(pages)
    assert sorted((r.position, r.type) for r in records.collect()) == [(0, "Article"), (3, "Unknown")]
    found = [(r.position, r.reason) for r in rejects.collect()]
    assert (None, "items") in found  # the page without items
    assert sorted(f for f in found if f[0] is not None) == [
        (1, "link"),
        (2, "main_title"),
    ]


def test_heading_scope(rows):
    html = listing(item(type="First"), item(type="Second"))
    pages = rows([(1, "https://s/", html)], PAGES)
    own, _ = extract.extract_listing(pages)
    shared, _ = extract.extract_listing(pages, heading_of_page=True)
    assert [r.type for r in own.orderBy("position").collect()] == ["First", "Second"]
    assert [r.type for r in shared.orderBy("position").collect()] == ["First", "First"]


def test_link_title_belongs_to_the_first_link(rows):
    html = listing(
        item().replace(' title="J">v</a>', '>v</a><a title="other" href="/o">w</a>')
    )
    records, _ = extract.extract_listing(rows([(1, "https://s/", html)], PAGES))
    assert (records.first().doi, records.first().publisher) == ("https://s/doi/1", "")


def page(rows, affiliations="", date="5 March 2021", html=ARTICLE_PAGE):
    text = html.format(affiliations=affiliations, date=date)
    return rows([(1, "https://s/doi/1", text)], PAGES)


def test_article_page(rows):
    people = PERSON.format("Ann", "MIT, Cambridge, USA") + PERSON.format("Bo", "MIT,")
    records, rejects = extract.extract_article_pages(page(rows, people))
    r = records.first()
    assert (r.abstract, r.authors, r.keywords) == ("An idea.", ["Ann B", "Bo & Co"], ["IoT", ""])
    assert (r.issn, r.published) == ("1234-5678", "5 March 2021")
    assert (r.universities, r.countries) == (["MIT, Cambridge", "MIT"], ["USA", ""])
    assert [a.asDict() for a in r.authors_with_affiliations] == [
        {
            "author": "Ann",
            "university": "MIT, Cambridge",
            "country": "USA",
            "location": "MIT, Cambridge, USA",
        },
        {"author": "Bo", "university": "MIT", "country": "", "location": "MIT,"},
    ]
    assert rejects.count() == 0


@pytest.mark.parametrize(
    "people", ["", PERSON.format("Ann", "MIT").replace("auth-institution", "other")]
)
def test_unknown_affiliations(rows, people):
    known = PERSON.format("Bo", "MIT") if people else ""
    records, _ = extract.extract_article_pages(page(rows, known + people))
    r = records.first()
    assert (r.universities, r.countries, r.authors_with_affiliations) == (["Unknown"], ["Unknown"], [])


def test_article_page_defaults_and_rejects(rows):
    bare = ARTICLE_PAGE
    for known in ("dropBlock", 'property="keywords"', 'class="space"'):
        bare = bare.replace(known, "y")
    records, _ = extract.extract_article_pages(page(rows, html=bare))
    assert (records.first().authors, records.first().keywords) == (["Unknown"], ["N/A"])
    assert records.first().issn == "N/A"
    undated = ARTICLE_PAGE.replace("core-date-published", "y")
    records, rejects = extract.extract_article_pages(page(rows, html=undated))
    assert (records.count(), rejects.first().reason) == (0, "published")


def test_build_articles(rows):
    counters = '<span class="metric">1,234</span><span class="citation">1,007</span>'
    bad = '<span class="citation">many</span>'
    html = listing(item("/doi/1", more=counters), item("/doi/2"), item("/doi/1", more=bad))
    items, _ = extract.extract_listing(rows([(1, "https://s/", html)], PAGES))
    pages, _ = extract.extract_article_pages(
        rows(
            [
                (k, "https://s/doi/1", ARTICLE_PAGE.format(date=d, affiliations=""))
                for k, d in ((7, "5 March 2021"), (9, "Mar 2021"))
            ],
            PAGES,
        )
    )
    articles, rejects = extract.build_articles(items, pages, "topic", "site", RUN)
    assert sorted((r.doi, r.reason) for r in rejects.collect()) == [
        ("https://s/doi/1", "citations"),
        ("https://s/doi/2", "article page"),
    ]
    (a,) = articles.collect()
    assert (a.title, a.Downloads, a.citations) == ("T", 1234, 1007)
    # Of two saved copies the later one counts; its date is unreadable.
    assert (a.Date, a.Year, a.Month, a.Day) == ("02 January 2024", 2024, "January", 2)
    assert (a.publisher.name, a.publisher.ISSN, a.publisher.Quartile) == ("J", "1234-5678", None)
    assert (a.topic, a.website) == ("topic", "site")
    declared = [(f.name, f.dataType.simpleString()) for f in ARTICLE]
    assert articles.dtypes == declared + [("page_id", "bigint"), ("position", "int")]


def test_large_broken_pages_stay_cheap(rows):
    """Megabytes of unclosed tags and of items; a quadratic search would not come back."""
    broken = "<a <a class=" * 100_000 + listing(*[item(f"/doi/{k}") for k in range(3000)])
    pages = rows([(1, "https://s/", broken), (2, "https://s/", "<" * 1_000_000)], PAGES)
    records, rejects = extract.extract_listing(pages)
    assert records.select("doi").distinct().count() == 3000
    assert [r.reason for r in rejects.collect()] == ["items"]
    assert extract.extract_article_pages(pages)[1].count() == 2


def test_cost_grows_with_the_page(rows):
    """Pages of many elements: closed, nested, and never closed."""
    rules = [
        extract.Rule("all", (Selector("p"),), many=True, default="none"),
        extract.Rule("inner", (Selector("ul"), Selector("li"), Selector("b")), many=True, default="none"),
        extract.Rule("first", (Selector("i"),), default="none"),
    ]

    def made(n):
        return "<p>x</p>" * n + "<i>" * n + "<ul>" + "<li><b>y</b></li>" * n + "</ul>" + "<q>" * n + "</q>" * n

    def seconds(n):
        start = time.perf_counter()
        records, _ = extract.extract_items(rows([(1, "u", made(n))], PAGES), rules)
        row = records.first()
        taken = time.perf_counter() - start
        assert (len(row["all"]), len(row["inner"]), row["first"]) == (n, n, "none")
        return taken

    seconds(1000)
    small, large = min(seconds(10_000) for _ in range(2)), min(seconds(40_000) for _ in range(2))
    assert large < 8 * small


def test_elements_by_their_own_tags(rows):
    """Nested, crossing, unclosed and self-closing elements, in and outside of containers."""
    html = (
        '<div class="a"><div class="b">1<div class="b">2</div>3</div><div class="b">4</div></div></div>'
        '<div class="b">5</div><ul><li>x<ul><li>y</li></ul></li><li>z</ul><br class="b"/>6<span class="b">7'
        '<div class="a"><span class="b">8</span><em class="b">9</div></em><q id="k\'1">10</q>'
    )
    rules = [
        extract.Rule("nested", (of_class("a"), of_class("b")), many=True),
        extract.Rule("every", (of_class("b"),), many=True),
        extract.Rule("items", (Selector("ul"), Selector("li")), many=True),
        extract.Rule("one", (of_class("a"), of_class("b"))),
        extract.Rule("lost", (of_class("zzz"),), default="no"),
        extract.Rule("by_value", (Selector(attribute=("ID", "k'1")),)),
        extract.Rule("any", (Selector(), Selector("em")), many=True),
    ]
    records, _ = extract.extract_items(rows([(1, "u", html)], PAGES), rules)
    row = records.first()
    assert row.nested == ["123", "4", "8"]
    assert row.every == ["123", "4", "5", "", "8", "9"]
    assert (row["items"], row.one, row.lost) == (["xy"], "123", "no")
    assert (row.by_value, row["any"]) == ("10", [])  # the one there is crosses its container


RANKING = '<div class="cellslide"><table><thead><tr><td>h</td><td>1</td><td>2</td></tr></thead><tbody>{}</tbody></table></div>'


def ranking(*rows_of_cells):
    return RANKING.format(
        "".join("<tr>" + "".join(f"<td> {c} </td>" for c in r) + "</tr>" for r in rows_of_cells)
    )


def test_rankings(rows):
    good = ranking(("A", "2020", "Q1"), ("A", "2019"), ("B", "2020", ""))
    void = ranking(("A", "2020", "Q1"), ("A", "n.d.", "Q1"))
    pages = rows([("J", good), ("K", void), ("L", "")], "journal string, html string")
    found = [tuple(r) for r in extract.extract_rankings(pages).orderBy("pos").collect()]
    assert found == [("J", 0, "A", 2020, "Q1"), ("J", 1, "B", 2020, "")]
    lenient = extract.extract_rankings(pages, strict=False)
    assert sorted((r.journal, r.pos) for r in lenient.collect()) == [("J", 0), ("J", 1), ("K", 0)]


def test_article_pages_are_indexed_once(rows):
    """Sections and fields read one index of a page; each had its own."""
    extracted = extract.extracted_article_pages(rows([(1, "https://s/", ARTICLE_PAGE)], PAGES))
    plan = extracted._jdf.queryExecution().analyzed().toString()
    assert plan.count("AS _entries#") == 1


def test_pieces_that_are_no_tags(rows):
    html = "a < b <P title='x > y'>1 <2 <b\n>bold</B><br/>&amp;<!DOCTYPE t>3 <i</p> <p>\"<p>inner</p></p>"
    rules = [extract.Rule("all", (Selector("p"),), many=True), extract.Rule("b", (Selector("b"),))]
    records, _ = extract.extract_items(rows([(1, "https://s/", html)], PAGES), rules)
    found = records.first()
    assert (found.all, found.b) == (["1 <2 bold&3 <i", '"inner'], "bold")
