"""Large arrays read by many tasks, against Python's own reader."""

from __future__ import annotations

import json
import random

import pytest

from pubweave import sources
from tests.test_plans import conf

SCHEMA = "a string, n long, o struct<b:string, c:array<struct<d:string>>>"
TEXTS = ["", "plain", '}, {"a": "', '"}]', "\\", '\\"', "\\\\", "[{", "é\n\t}", "{}", None, '"a":}', "},\n{"]


def made(rng, count):
    return [
        {
            "a": rng.choice(TEXTS),
            "n": rng.choice([None, k]),
            "o": rng.choice([None, {}, {"b": rng.choice(TEXTS), "c": [{"d": rng.choice(TEXTS)}] * rng.randint(0, 3)}]),
        }
        for k in range(count)
    ]


def shape(record):
    inner = record.get("o")
    if inner is not None:
        inner = (inner.get("b"), None if inner.get("c") is None else [c["d"] for c in inner["c"]])
    return repr((record["a"], record["n"], inner))


def found(df):
    return sorted(shape(r.asDict(recursive=True)) for r in df.collect())


@pytest.mark.parametrize("split", ["64", "300", "100m"])
def test_arrays_agree_with_python(spark, tmp_path, split):
    rng = random.Random(split)
    files = {"one": made(rng, 400), "two": made(rng, 50), "none": [], "single": made(rng, 1)}
    for name, records in files.items():
        text = json.dumps(records, indent=rng.choice([None, 2]), ensure_ascii=False)
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    (tmp_path / "object.json").write_text("  " + json.dumps(made(rng, 1)[0], indent=1) + "\n", encoding="utf-8")
    (tmp_path / "empty.json").write_text("")
    expected = [r for name in files for r in files[name]] + [json.loads((tmp_path / "object.json").read_text())]
    schema = spark.createDataFrame([], SCHEMA).schema
    with conf(spark, spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="0"):
        read = sources.read_json_arrays(spark, str(tmp_path), schema)
        assert found(read) == sorted(map(shape, expected))


def test_a_large_array_is_many_tasks(spark, tmp_path):
    text = "[\n" + ",\n".join(json.dumps({"a": f"}}{{{k}", "n": k, "o": None}) for k in range(200_000)) + "\n]"
    (tmp_path / "large.json").write_text(text)
    schema = spark.createDataFrame([], SCHEMA).schema
    with conf(spark, spark__sql__files__maxPartitionBytes="1m"):
        from pubweave.sources import json_arrays

        assert json_arrays._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 4
        read = sources.read_json_arrays(spark, str(tmp_path), schema)
        assert read.agg({"n": "sum"}).first()[0] == sum(range(200_000))
        assert read.where("a = concat('}{', n)").count() == 200_000


def test_records_as_one_array(spark, rows, tmp_path):
    df = rows([("x", 1), (None, 2), ('"}', None)], "`a.b` string, n int")
    sources.write_records(df, str(tmp_path / "out"), as_array=True)
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == [{"a.b": "x", "n": 1}, {"a.b": None, "n": 2}, {"a.b": '"}', "n": None}]
    sources.write_records(df.limit(0), str(tmp_path / "out"), as_array=True)
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == []
