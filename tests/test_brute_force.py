"""Operators against plain Python on random small inputs."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from pubweave.operators import cited, countries, enrich, extract, ingest, keywords, topics

SEEDS = [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
def test_merge_is_a_dictionary_by_key(rows, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 20 + [None] + [f"k{k}" for k in range(12)]
    old = [(rng.choice(keys), k, f"old{k}") for k in range(40)]
    new = [(rng.choice(keys), k, f"new{k}") for k in range(60)]
    expected = {}
    for key, _, value in old + new:
        expected[key] = value
    schema = "doi string, seq int, v string"
    merged = ingest.merge_articles(rows(old, schema), rows(new, schema)).orderBy("first_position")
    assert [(r.doi, r.v) for r in merged.collect()] == list(expected.items())


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("limit", [0, 10**9])
def test_new_only_is_a_lookup_per_record(rows, seed, limit):
    rng = random.Random(seed)
    keys = ["hot"] * 10 + [None] * seed + [f"k{k}" for k in range(30)]
    old = [(rng.choice(keys),) for _ in range(8)]
    new = [(rng.choice(keys), k) for k in range(80)]
    stored, schema = rows(old, "doi string"), "doi string, n int"
    for null_safe in (False, True):
        known = {k for (k,) in old if null_safe or k is not None}
        found = ingest.new_only(
            rows(new, schema), stored, null_safe=null_safe, broadcast_bytes=limit
        )
        assert sorted(r.n for r in found.collect()) == [n for k, n in new if k not in known]


def quartile(article_year, entries, lookback):
    """The rule as a loop: the first row of a year decides it, an empty one is passed over."""
    for year in range(article_year, article_year - lookback, -1):
        decided = next((q for y, q in entries if y == year), "")
        if decided:
            return decided
    return ""


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("lookback", [1, 3, 10])
def test_quartiles_are_a_loop_over_years(rows, seed, lookback):
    rng = random.Random(seed)
    table = {
        f"J{j}": [
            (rng.randint(1995, 2010), rng.choice(["", "Q1", "Q2", "Q3", "-"]))
            for _ in range(rng.randint(0, 12))
        ]
        for j in range(8)
    }
    ranked = [(j, p, "c", y, q) for j, es in table.items() for p, (y, q) in enumerate(es)]
    ranked.append(("other", 0, "c", 2000, "Q1"))
    data = [
        (k, (f" J{rng.randint(0, 9)}", "", rng.choice([None, "", "Q9"])), rng.randint(1990, 2022))
        for k in range(150)
    ]
    articles = rows(data, "id int, publisher struct<name:string,ISSN:string,Quartile:string>, Year int")
    rankings = rows(ranked, "journal string, pos int, category string, Year int, Quartile string")
    found = enrich.enrich_quartile(articles, rankings, lookback)
    expected = {
        k: q or quartile(year, table.get(name.strip(), []), lookback)
        for k, (name, _, q), year in data
    }
    assert {r.id: r.publisher.Quartile for r in found.collect()} == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_top_cited_is_a_stable_sort(rows, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice([1999, 2000, 2000, 2000, 0]), k, f"t{k}", rng.choice([1.0, 2.0, 9.0, None, math.nan]))
        for k in range(200)
    ]
    top = cited.top_cited_per_year(
        rows(data, "Year int, seq int, title string, citations double"), n=7, tie_break="seq"
    )
    found = {(r.Year, r.position): r.title for r in top.collect()}
    expected = {}
    for year in {d[0] for d in data}:
        known = [d for d in data if d[0] == year]
        known.sort(key=lambda d: -d[3] if d[3] is not None and not math.isnan(d[3]) else math.inf)
        expected |= {(year, p + 1): d[2] for p, d in enumerate(known[:7])}
    assert found == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_counts_and_pivots(rows, seed):
    rng = random.Random(seed)
    words = [" IoT", "iot\t", "AI", "", None, "n/a", "é É"]
    places = ["france", " France ", "USA", "usa ", "", None, "Atlantis", "united kingdom"]
    data = [
        (
            rng.choice([0, 1999, 2000]),
            rng.choice(["a", "b"]),
            rng.choices(words, k=rng.randint(0, 5)),
            rng.choices(places, k=rng.randint(0, 4)),
        )
        for _ in range(120)
    ]
    articles = rows(data, "Year int, topic string, keywords array<string>, countries array<string>")
    counted = Counter(w.lower().strip() for d in data for w in d[2] if w is not None)
    found = [tuple(r) for r in keywords.keyword_counts(articles).collect()]
    assert found == sorted(counted.items(), key=lambda kv: (-kv[1], kv[0]))

    spelling = {n.title(): n for n in countries.DEFAULT_COUNTRIES}
    located = [
        (spelling[p.strip(" ").title()], d[1])
        for d in data
        for p in d[3]
        if p and p.strip(" ").title() in spelling
    ]
    found = {(r.country, r.topic): r["count"] for r in countries.country_topic_counts(articles).collect()}
    assert found == Counter(located)

    by_cell = Counter((year, topic) for year, topic, *_ in data)
    names = sorted({topic for _, topic in by_cell})
    found = topics.year_topic_pivot(articles)
    assert found.columns == ["Year", *names]
    assert [tuple(r) for r in found.collect()] == [
        (year, *(by_cell[year, name] for name in names)) for year in sorted({y for y, _ in by_cell})
    ]


@pytest.mark.parametrize("seed", SEEDS)
def test_listing_items_come_back(rows, seed):
    """Random records written into the template and read back."""
    rng = random.Random(seed)

    def text():
        return "".join(rng.choices("ab é,.x1", k=rng.randint(1, 12))).strip() or "t"

    def spaced(value):
        return " ".join(value.split())

    pages, expected = [], []
    for page in range(20):
        parts = []
        for position in range(rng.randint(0, 4)):
            link, name, title = f"/doi/{page}.{position}", text(), text()
            sub, count = rng.choice([None, text()]), rng.choice([None, str(rng.randint(0, 9999))])
            noise = rng.choice(["", "<!-- x -->", '<div class="metrics">9</div>', "<p>&amp;</p>"])
            parts.append(
                f'<li id="i" class="issue-item issue-item--search clearfix">{noise}'
                f'<div class="issue-item__detail"><a title="{name}" href="{link}">x</a></div>'
                f'<h5 class="hlFld-Title"><b>{title}</b></h5>'
                + (f'<div class="hlFld-SubTitle"> {sub}</div>' if sub else "")
                + (f'<span class="x metric y">{count}</span>' if count else "")
                + "</li>"
            )
            expected.append(
                (page, position, f"https://s{link}", name, spaced(title), spaced(sub or ""), count or "N/A")
            )
        pages.append((page, "https://s/list", "<ul>" + "\n".join(parts) + "</ul><p>end</p>"))
    records, rejects = extract.extract_listing(rows(pages, "page_id int, url string, html string"))
    found = records.select(
        "page_id", "position", "doi", "publisher", "main_title", "sub_title", "downloads_text"
    )
    assert sorted(tuple(r) for r in found.collect()) == expected
    empty = [page for page, _, html in pages if "<li" not in html]
    assert sorted((r.page_id, r.reason) for r in rejects.collect()) == [(p, "items") for p in empty]
