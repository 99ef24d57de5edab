from __future__ import annotations

import json

import pytest

from pubweave import sources, storage
from pubweave.schema import ARTICLE, ARTICLE_MERGED


def test_json_array_object_and_absent_file(spark, tmp_path):
    article = {"title": "t", "authors": ["a"], "Year": 2020, "publisher": {"name": "J"}, "x": 1}
    (tmp_path / "array.json").write_text(json.dumps([article, article], indent=4))
    (tmp_path / "object.json").write_text(json.dumps(article))

    def read(name, **options):
        return sources.read_articles(spark, str(tmp_path / name), "json", **options)

    assert read("array.json", multi_line=True).count() == 2
    assert read("object.json", multi_line=True).first().publisher.name == "J"
    assert read("object.json").schema == ARTICLE
    absent = read("none.json")
    assert (absent.count(), absent.schema) == (0, ARTICLE)
    merged = read("object.json", schema=ARTICLE_MERGED, multi_line=True).first()
    assert (merged.Year, merged.locations) == ("2020", None)


def test_collection_reads_id_as_text(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"_id": 12, "doi": "d"}')
    schema = "_id int, doi string"
    df = sources.read_collection(spark, "json", {"path": str(tmp_path / "c.json")}, schema)
    assert df.first().asDict() == {"_id": "12", "doi": "d"}


def test_csv(spark, rows, tmp_path):
    table = rows([("a, \"b\"", 7), (None, 8)], "country string, n bigint")
    sources.write_csv(table, str(tmp_path / "t"), single_file=True)
    assert len(list((tmp_path / "t").glob("*.csv"))) == 1
    back = sources.read_table_csv(spark, str(tmp_path / "t"), table.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_csv_records(spark, rows, tmp_path):
    table = rows([("007", "x\"y", "0"), (None, "-3", "1.5")], "`a b` string, c string, d string")
    sources.write_csv(table, str(tmp_path / "t"))
    records = sources.csv_records(spark, str(tmp_path / "t"), table.columns)
    found = [json.loads(r.value) for r in records.collect()]
    assert sorted(found, key=str) == sorted(
        [{"a b": 7, "c": 'x"y', "d": 0}, {"a b": "", "c": "-3", "d": "1.5"}], key=str
    )


def test_append_creates_then_adds(spark, rows, tmp_path):
    path = str(tmp_path / "set")
    part = rows([("a", "t1"), ("b", "t2")], "doi string, topic string")
    sources.append_articles(part, path)
    sources.append_articles(part, path)
    stored = sources.read_articles(spark, path, schema=part.schema)
    assert stored.count() == 4
    assert stored.filter("topic = 't1'").count() == 2
    unpartitioned = str(tmp_path / "flat")
    sources.append_articles(part, unpartitioned, format="json", partition_by=None)
    assert sources.read_articles(spark, unpartitioned, "json", part.schema).count() == 2


def test_rewrite_may_read_what_it_replaces(spark, rows, tmp_path):
    root = str(tmp_path / "set")
    assert sources.current_version(spark, root) is None
    sources.rewrite_articles(rows([("a",)], "doi string"), root)
    first = sources.current_version(spark, root)
    stored = sources.read_articles(spark, first, schema=stored_schema(spark))
    sources.rewrite_articles(stored.union(stored), root)
    second = sources.current_version(spark, root)
    assert second != first
    assert sources.read_articles(spark, second, schema=stored_schema(spark)).count() == 2
    # A version without its success marker does not count, and its name is not used again.
    (tmp_path / "set" / "version=3").mkdir()
    assert sources.current_version(spark, root) == second
    assert sources.rewrite_articles(stored, root).endswith("version=4")


def stored_schema(spark):
    return spark.createDataFrame([], "doi string").schema


def test_records(spark, rows, tmp_path):
    sources.write_records(rows([(2000, None)], "Year int, topic string"), str(tmp_path / "r"))
    text = "".join(f.read_text() for f in (tmp_path / "r").glob("*.json"))
    assert json.loads(text) == {"Year": 2000}


def test_checkpoint_root_is_the_sessions(spark):
    assert spark.conf.get("spark.checkpoint.dir") in storage.checkpoint_root(spark)


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), conf


def test_checkpoint_folder_is_ours_only_on_a_local_master(monkeypatch):
    monkeypatch.setattr(storage.tempfile, "mkdtemp", lambda prefix: "/tmp/own")
    assert storage.checkpoint_root(_Session("local[2]")) == "/tmp/own"
    shared = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert storage.checkpoint_root(_Session("yarn", **shared)) == "hdfs:///shared"
    assert storage.checkpoint_root(_Session("local[2]", **shared)) == "hdfs:///shared"
    with pytest.raises(ValueError):
        storage.checkpoint_root(_Session("yarn"))


def test_measured_size_decides(rows):
    df = rows([("x" * 100, 1, ["y" * 50, None])] * 10, "s string, n int, l array<string>")
    stored = storage.store(df, "t")
    assert 1500 < stored.size < 5000
    small = stored.joinable(10**6)._jdf.queryExecution().toString()
    large = stored.joinable(10)._jdf.queryExecution().toString()
    assert "broadcast" in small and "broadcast" not in large
    empty = storage.store(df.limit(0), "t")
    assert (empty.size, empty.table.count()) == (0, 0)


@pytest.mark.parametrize("size,expected", [(0, 8), (128 * 2**20 * 100, 100), (2**60, 100_000)])
def test_bucket_count(spark, size, expected):
    assert storage.bucket_count(spark, size) == expected
