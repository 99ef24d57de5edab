"""Rounds of ``author_pagerank`` over vectors."""

from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from pubweave.operators import pagerank as pr
from pubweave.operators import rank_blocks
from tests.test_pagerank import as_dict, brute_force, paper_edges, random_papers

SCHEMA = "authors array<string>, Year int"


@pytest.fixture
def by_vectors(monkeypatch):
    """Small graphs go by vectors too, in rows of a few memberships; what was stored in blocks is returned."""
    stored, kept = [], rank_blocks.store_bucketed
    monkeypatch.setattr(pr, "PACKED_FROM", 1)
    monkeypatch.setattr(rank_blocks, "PIECE", 40)
    monkeypatch.setattr(pr, "_author_rounds_in_place", lambda *a: pytest.fail("rounds go by rows"))

    def capture(df, key, buckets):
        made = kept(df, key, buckets)
        stored.append(made.table.withColumn("file", F.input_file_name()).collect())
        return made

    monkeypatch.setattr(rank_blocks, "store_bucketed", capture)
    return stored


@pytest.mark.parametrize("rounds", [1, 7])
def test_rounds_over_vectors(rows, by_vectors, rounds):
    """An author of a third of all papers, copies, missing names; several pieces a block."""
    papers = random_papers(rounds, n=400)
    found = as_dict(pr.author_pagerank(rows(papers, SCHEMA), max_iter=rounds, broadcast_bytes=0))
    assert found == pytest.approx(brute_force(paper_edges(papers), rounds), abs=1e-9)
    pieces = [row.block for row in by_vectors[0] if row.members is not None]
    assert len(pieces) > len(set(pieces)) > 1


def test_every_round_runs_and_is_written_in_time(rows, by_vectors, monkeypatch):
    written, kept = [], rank_blocks.store
    monkeypatch.setattr(rank_blocks, "store", lambda df, label: written.append(label) or kept(df, label))
    papers = [(["a", "b"], 2000), (["b", "c"], 2000)]
    found = as_dict(pr.author_pagerank(rows(papers, SCHEMA), max_iter=50, broadcast_bytes=0))
    assert found == pytest.approx(brute_force(paper_edges(papers), 50), abs=1e-9)
    assert written.count("ranks") == 50 // pr.ROUNDS_PER_JOB + 1


def test_a_round_sends_an_author_once_to_a_block(rows, by_vectors):
    """The hub of all papers, of 24,000 memberships, is one number a block; its papers are in all blocks, and
    each with their other authors."""
    papers = [(["hub", f"a{k}", f"b{k}"], 2000) for k in range(8000)]
    assert pr.author_pagerank(rows(papers, SCHEMA), max_iter=1, broadcast_bytes=0).count() == 16001
    blocks = {row.block for row in by_vectors[0]}
    sent = sum(len(row.ids) // 8 for row in by_vectors[0] if row.ids is not None)
    sizes = [len(row.members) // 4 for row in by_vectors[0] if row.members is not None]
    assert len(blocks) == 8 and sent == 16000 + 8 and sum(sizes) == 24000
    held = {b: sum(len(r.members) for r in by_vectors[0] if r.block == b and r.members is not None) for b in blocks}
    assert max(held.values()) < 1.5 * sum(held.values()) / 8
    # Each block has a bucket, and so a task, of its own.
    assert len({(row.file, row.block) for row in by_vectors[0]}) == len({row.file for row in by_vectors[0]}) == 8


def test_a_paper_larger_than_a_block_goes_by_rows(rows, monkeypatch):
    in_place, kept = [], pr._rounds_in_place
    monkeypatch.setattr(pr, "PACKED_FROM", 1)
    monkeypatch.setattr(rank_blocks, "BLOCK", 20)
    monkeypatch.setattr(pr, "_rounds_in_place", lambda *a: in_place.append(a[2]) or kept(*a))
    papers = [([f"a{k}" for k in range(30)], 2000), (["a1", "b"], 2000)]
    found = as_dict(pr.author_pagerank(rows(papers, SCHEMA), max_iter=2, broadcast_bytes=0))
    assert found == pytest.approx(brute_force(paper_edges(papers), 2), abs=1e-9) and in_place == [2]


def test_top_authors_over_vectors(rows, by_vectors):
    """Equal ranks tie by id, whichever block they come from."""
    papers = [(["hub", f"a{k:02}", f"b{k:02}"], 2000) for k in range(40)]
    ranks = pr.author_pagerank(rows(papers, SCHEMA), max_iter=10, broadcast_bytes=0)
    top = [row.id for row in pr.top_authors(ranks, 6, digits=6).collect()]
    assert top == ["hub", "a00", "a01", "a02", "a03", "a04"]
    assert len({row.block for row in by_vectors[0]}) > 1


def test_no_table_remains(spark, rows, by_vectors):
    assert pr.author_pagerank(rows([(["a", "b"], 2000)], SCHEMA), max_iter=6, broadcast_bytes=0).count() == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("pubweave")] == []


def test_tasks_need_no_package(tmp_path):
    """Executors need not have it."""
    packed = CloudPickleSerializer().dumps(rank_blocks._steps([3, 5], 0.15, 10))
    (tmp_path / "steps").write_bytes(packed)
    code = f"import pickle; print(sorted(pickle.loads(open({str(tmp_path / 'steps')!r}, 'rb').read())))"
    code = f"import sys; sys.modules['pubweave'] = None; {code}"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert "'add'" in run.stdout, run.stderr
