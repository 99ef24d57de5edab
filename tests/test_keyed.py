"""The bucketed set: what an upsert rewrites, and what it leaves."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F, types as T

from pubweave import sources
from pubweave.sources import keyed

SCHEMA = T.StructType().add("doi", "string").add("text", "string")


def batch(rows, *given):
    return rows([(*g, k) for k, g in enumerate(given)], "doi string, text string, seq int")


def records(spark, root):
    return sorted(sources.read_keyed(spark, root, SCHEMA).collect(), key=str)


def files(root):
    """Bucket -> names of the files that the newest manifest counts."""
    manifest = sources.current_manifest(SparkSession.active(), root)
    return {b: sorted(p.name for p in Path(root, "data", f).glob("*.parquet")) for b, f in manifest.folders.items()}


def test_only_touched_buckets_are_rewritten(spark, rows, tmp_path):
    root = str(tmp_path / "set")
    assert records(spark, root) == []
    sources.upsert(batch(rows, *[(f"k{k}", "old") for k in range(200)]), root, SCHEMA, buckets=16)
    before = files(root)
    assert len(before) == 16
    done = sources.upsert(batch(rows, ("k5", "first"), ("k5", "last"), ("new", "n")), root, SCHEMA)
    touched, after = done.touched, files(root)
    assert (done.before, done.after) == (200, 201)
    assert 0 < len(touched) <= 2
    assert all((after[b] == before[b]) == (b not in touched) for b in before)
    found = {r.doi: r.text for r in records(spark, root)}
    assert len(found) == 201 and found["k5"] == "last" and found["new"] == "n" and found["k6"] == "old"
    # Only what can hold the new keys is read for comparing.
    near = sources.read_buckets_of(batch(rows, ("k5", "")), root, SCHEMA)
    assert 0 < near.count() < 60 and near.where("doi = 'k5'").count() == 1
    none = sources.upsert(batch(rows, ("x", "y")).limit(0), root, SCHEMA)
    assert (none.touched, none.before, none.after) == ([], 201, 201) and files(root) == after


def test_a_failed_run_leaves_the_old_manifest(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    sources.upsert(batch(rows, ("a", "1"), ("b", "1")), root, SCHEMA, buckets=4)
    kept = files(root)
    bad = batch(rows, ("a", "2")).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sources.upsert(bad, root, SCHEMA)

    def lost(*args):
        raise RuntimeError("before the manifest")

    monkeypatch.setattr(keyed, "_write_manifest", lost)
    with pytest.raises(RuntimeError):
        sources.upsert(batch(rows, ("a", "3")), root, SCHEMA)
    monkeypatch.undo()
    assert files(root) == kept and [r.text for r in records(spark, root)] == ["1", "1"]
    sources.upsert(batch(rows, ("a", "4"), ("b", "4")), root, SCHEMA)
    assert [r.text for r in records(spark, root)] == ["4", "4"]
    assert len(sources.vacuum(spark, root)) == 2
    assert [r.text for r in records(spark, root)] == ["4", "4"]


def test_records_without_a_key(spark, rows, tmp_path):
    new = batch(rows, (None, "x"), (None, "y"), (None, "y"), ("a", "z"))
    for keep, expected in ((True, 4), (False, 2)):
        root = str(tmp_path / f"set{keep}")
        sources.upsert(new, root, SCHEMA, keep_unkeyed=keep, buckets=8)
        assert len(records(spark, root)) == expected
        sources.upsert(new, root, SCHEMA, keep_unkeyed=keep)
        assert len(records(spark, root)) == (7 if keep else 2)


def test_odd_keys_and_names(spark, rows, tmp_path):
    schema = T.StructType([T.StructField("a.b", T.StringType())])
    for name in ("bucket", "record", "key"):
        schema = schema.add(name, T.IntegerType())
    new = rows([("é/=", 1, 2, 3, 0), ("", 4, 5, 6, 1), ("é/=", 7, 8, 9, 2)], "`a.b` string, bucket int, record int, key int, seq int")
    sources.upsert(new, str(tmp_path / "set"), schema, key="a.b", buckets=3)
    found = sources.read_keyed(spark, str(tmp_path / "set"), schema)
    assert sorted(tuple(r) for r in found.collect()) == [("", 4, 5, 6), ("é/=", 7, 8, 9)]
