from __future__ import annotations

import itertools
import random

import pytest

from pubweave.operators import pagerank as pr
from pubweave.operators.coauthors import coauthor_edges
from pubweave.storage import Dealt, store_bucketed


def brute_force(edges, rounds, reset=0.15):
    """Plain loop over parallel edges; the sum is scaled to the number of vertices."""
    ids = sorted({v for e in edges for v in e})
    outdegree = {v: sum(1 for s, _ in edges if s == v) for v in ids}
    rank = {v: 1.0 for v in ids}
    for _ in range(rounds):
        got = dict.fromkeys(ids, 0.0)
        for s, d in edges:
            got[d] += rank[s] / outdegree[s]
        rank = {v: reset + (1 - reset) * got[v] for v in ids}
    scale = len(ids) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def paper_edges(papers):
    distinct = {(tuple(a), y) for a, y in papers}
    return [e for a, _ in distinct for e in itertools.permutations(set(a) - {None}, 2)]


def random_papers(seed, n=60):
    rng = random.Random(seed)
    people = [f"p{k}" for k in range(15)] + [None]
    made = [(rng.choices(people, k=rng.randint(0, 6)), rng.choice([2000, 2001])) for _ in range(n)]
    # One author writes a third of all papers, and one paper is stored very often.
    made += [(["hub", rng.choice(people[:15])], 2000) for _ in range(n // 2)]
    return made + [(["hub", "p1"], 1999)] * n


def as_dict(df):
    return {r.id: r.pagerank for r in df.collect()}


@pytest.mark.parametrize("limit", [0, pr.BROADCAST_BYTES])
@pytest.mark.parametrize("rounds", [1, 7, 50])
def test_author_pagerank(rows, limit, rounds):
    papers = random_papers(rounds)
    articles = rows(papers, "authors array<string>, Year int")
    found = as_dict(pr.author_pagerank(articles, max_iter=rounds, broadcast_bytes=limit))
    expected = brute_force(paper_edges(papers), rounds)
    assert found.keys() == expected.keys()
    assert found == pytest.approx(expected, abs=1e-9)
    assert sum(found.values()) == pytest.approx(len(found))


@pytest.mark.parametrize("limit", [0, pr.BROADCAST_BYTES])
def test_pagerank_of_edges(rows, limit):
    papers = random_papers(3)
    edges = coauthor_edges(rows(papers, "authors array<string>, Year int"))
    found = as_dict(pr.pagerank(edges, max_iter=20, broadcast_bytes=limit))
    assert found == pytest.approx(brute_force(paper_edges(papers), 20), abs=1e-9)


def test_pagerank_with_sinks_self_loops_and_parallel_edges(rows):
    edges = [("a", "b"), ("a", "b"), ("a", "c"), ("c", "a"), ("c", "c"), ("d", "c")]
    found = as_dict(pr.pagerank(rows(edges, "src string, dst string"), max_iter=10))
    assert found == pytest.approx(brute_force(edges, 10), abs=1e-9)


def test_every_round_runs(rows, monkeypatch):
    """A graph whose ranks settle at once still gets all its rounds."""
    written = []
    monkeypatch.setattr(pr, "store", lambda df, label, f=pr.store: written.append(label) or f(df, label))
    pr.author_pagerank(rows([(["a", "b"], 2000)], "authors array<string>, Year int"), max_iter=50)
    assert written.count("ranks") == 1 + 50 // pr.ROUNDS_PER_JOB


@pytest.mark.parametrize("graph", ["authors", "edges"])
def test_all_rounds_together_bound_what_is_broadcast(rows, monkeypatch, graph):
    """Ranks of some 10 kB would fit a broadcast of 20 kB, but not 50 of them."""
    papers = [(["hub", f"a{k}", f"b{k}"], 2000) for k in range(60)]
    articles, in_place = rows(papers, "authors array<string>, Year int"), []
    kept = pr._rounds_in_place
    monkeypatch.setattr(pr, "_rounds_in_place", lambda s, r, n, b: in_place.append(n) or kept(s, r, min(n, 3), b))
    run = pr.author_pagerank if graph == "authors" else lambda a, **more: pr.pagerank(coauthor_edges(a), **more)
    assert run(articles, max_iter=2, broadcast_bytes=20_000).count() == 121 and in_place == []
    assert run(articles, max_iter=50, broadcast_bytes=20_000).count() == 121 and in_place == [50]


def test_rounds_in_place_broadcast_no_ranks(rows, monkeypatch):
    articles, plans, written = rows(random_papers(2), "authors array<string>, Year int"), [], []

    def capture(start, one_round, max_iter, buckets):
        written.append(dict(start.table.dtypes)["id"])
        plans.append(one_round(start.table)._jdf.queryExecution().executedPlan().toString())
        return start.table

    monkeypatch.setattr(pr, "_rounds_in_place", capture)
    monkeypatch.setattr(pr, "deal", cold)
    pr.author_pagerank(articles, broadcast_bytes=0)
    pr.pagerank(coauthor_edges(articles), broadcast_bytes=0)
    assert all("ShuffledHashJoin" in p and "BroadcastHashJoin" not in p for p in plans)
    assert written == ["bigint", "bigint"]  # rounds shuffle numbers, not names


def cold(df, key, buckets):
    return Dealt(store_bucketed(df.repartition(buckets, key), key, buckets), None, None)


def test_integer_vertices(rows):
    edges = [(1, 2), (1, 2), (2, 3), (3, 1), (4, 1), (5, 6)]
    for limit in (0, pr.BROADCAST_BYTES):
        found = as_dict(pr.pagerank(rows(edges, "src long, dst long"), max_iter=8, broadcast_bytes=limit))
        assert found == pytest.approx(brute_force(edges, 8), abs=1e-9)


def test_no_edges(rows):
    articles = rows([(["a"], 2000)], "authors array<string>, Year int")
    assert pr.author_pagerank(articles).count() == 0
    assert pr.pagerank(coauthor_edges(articles)).count() == 0


def test_top_authors(rows):
    ranks = rows([("b", 1.0000001), ("a", 1.0), ("c", 2.0)], "id string, pagerank double")
    assert [r.id for r in pr.top_authors(ranks, 2).collect()] == ["c", "b"]
    assert [r.id for r in pr.top_authors(ranks, 2, digits=6).collect()] == ["c", "a"]


def test_no_catalog_entry_remains(spark, rows):
    articles = rows([(["a", "b"], 2000)], "authors array<string>, Year int")
    for limit in (0, pr.BROADCAST_BYTES):
        assert pr.author_pagerank(articles, max_iter=2, broadcast_bytes=limit).count() == 2
        assert pr.pagerank(coauthor_edges(articles), max_iter=2, broadcast_bytes=limit).count() == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("pubweave")] == []
