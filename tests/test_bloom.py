"""The Bloom index: files that it skips, and that nothing is lost by it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pubweave import sources
from pubweave.operators import ingest
from pubweave.sources import bloom

SCHEMA = "doi string, n long"


def written(spark, path, count, each):
    """``count`` files of ``each`` records with keys of their own."""
    for k in range(count):
        own = spark.range(k * each, (k + 1) * each).select(F.concat(F.lit("k"), "id").alias("doi"), F.col("id").alias("n"))
        sources.append_articles(own.coalesce(1), path, partition_by=None)


def test_most_files_are_skipped(spark, rows, tmp_path):
    path, schema = str(tmp_path / "set"), rows([], SCHEMA).schema
    assert bloom.files_with(rows([("k1", 0)], SCHEMA), path) == [] and bloom.index_files(spark, path, schema) == 0
    written(spark, path, 12, 3000)
    assert bloom.index_files(spark, path, schema) == 12 and bloom.index_files(spark, path, schema) == 0
    wanted = rows([("k1", 0), ("k17000", 0), ("none", 0), (None, 0)], SCHEMA)
    files = bloom.files_with(wanted, path)
    assert 2 <= len(files) <= 4  # two that hold a key; a wrong hit is rare
    near = bloom.read_files_of(wanted, path, schema)
    assert {r.doi for r in near.join(wanted.select("doi"), "doi").collect()} == {"k1", "k17000"}
    # A file that isn't indexed yet is read; readers of the set don't see the index.
    sources.append_articles(rows([("late", 5)], SCHEMA).coalesce(1), path, partition_by=None)
    assert len(bloom.files_with(wanted, path)) == len(files) + 1
    assert sources.read_articles(spark, path, schema=schema).count() == 36_001


def test_folders_with_odd_names(spark, rows, tmp_path):
    path, schema = str(tmp_path / "a set"), rows([], "doi string, topic string").schema
    given = [(f"k{k}", t) for k, t in enumerate(["a b", "ü%2F/x", "", None, "y=1"])]
    sources.append_articles(rows(given, "doi string, topic string"), path)
    assert bloom.index_files(spark, path, schema) > 1 and bloom.index_files(spark, path, schema) == 0
    for key, topic in given:
        near = bloom.read_files_of(rows([(key, "")], "doi string, topic string"), path, schema)
        assert (key, topic) in {tuple(r) for r in near.collect()}


def test_tasks_of_the_index_grow_with_its_keys(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(bloom, "TASK_KEYS", 500)
    monkeypatch.setattr(bloom, "BITS_PER_KEY", 400)
    path, schema = str(tmp_path / "set"), rows([], SCHEMA).schema
    written(spark, path, 1, 5000)  # one file of 64 blocks
    sources.append_articles(rows([("k1", 0), (None, 0)] * 50, SCHEMA).coalesce(1), path, partition_by=None)
    assert bloom.index_files(spark, path, schema) == 2
    index = spark.read.parquet(f"{path}/_bloom")
    assert index.count() == index.select("file", "block").distinct().count() > 60
    assert len(index.inputFiles()) >= 8  # each was one task's
    assert len(bloom.files_with(rows([(None, 0)], SCHEMA), path)) == 1
    assert len(bloom.files_with(rows([("k1", 0)], SCHEMA), path)) == 2


@pytest.mark.parametrize("fill", [0.02, 16, 400])
def test_nothing_is_lost_at_any_fill(spark, rows, tmp_path, fill, monkeypatch):
    """``fill``: bits per key, from crowded to roomy."""
    monkeypatch.setattr(bloom, "BITS_PER_KEY", fill)
    rng = random.Random(1)
    path, schema = str(tmp_path / "set"), rows([], SCHEMA).schema
    stored = [(rng.choice([None, f"k{rng.randrange(4000)}"]), k) for k in range(6000)]
    rows(stored, SCHEMA).repartition(6).write.parquet(path)
    bloom.index_files(spark, path, schema)
    new = rows([(f"k{k * 7}", k) for k in range(900)] + [(None, 1)], SCHEMA)
    for null_safe in (True, False):
        whole = ingest.new_only(new, sources.read_articles(spark, path, schema=schema), null_safe=null_safe)
        near = ingest.new_only(new, bloom.read_files_of(new, path, schema), null_safe=null_safe)
        assert sorted(map(str, near.collect())) == sorted(map(str, whole.collect()))
