"""The registered queries and the pipeline."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pubweave.llm import minhash
from pubweave.llm.oracles import ORACLES
from pubweave.llm.queries import QUERIES
from tests import oracle_check

SF_DIR = "/root/testdata/sf0.001"
ROWS = {"pages": "op2", "embeddings": "op10"}


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    connection = oracle_check.connect(SF_DIR)
    assert oracle_check.differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_each_row(spark, name):
    table = next((t for t, q in ROWS.items() if name.startswith(q + "_")), "documents")
    given = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert QUERIES[name](spark, SF_DIR).count() >= given


def test_native_queries_run_no_python(spark):
    for name in ("op2_url_filters", "op3_line_dedup", "op5_secret_scans", "op7_chat_formatting"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def test_pipeline_stages(spark):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF_DIR))
    assert all(d.columns == docs.columns for d in kept[:-1])
    counts = [d.count() for d in kept[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4] > 100
    classes = minhash.near_duplicates(kept[3])
    assert classes.where("doc_id <> class_id").count() == 0
    assert kept[4].where("text rlike 'AKIA[A-Z0-9]{16}|[0-9a-f]{24}'").count() == 0
    packed = {d for r in kept[5].select("doc_ids").collect() for d in r.doc_ids}
    assert packed == {r.doc_id for r in kept[4].select("doc_id").collect()}
    by_run = {d for r in corpus_pipeline.run(spark, SF_DIR).select("doc_ids").collect() for d in r.doc_ids}
    assert by_run == packed


def test_pipeline_on_odd_tables(spark, rows, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, verdict int, row string"
    rng = random.Random(15)
    long_text = " ".join("".join(rng.choices("aeinrst", k=rng.randint(2, 9))) for _ in range(12_000))
    short = " ".join(f"ant{k} bee{k}" for k in range(20))
    given = [(1, None), (2, ""), (3, short), (4, short), (5, long_text), (None, None), (6, short + " cat")]
    for name, data in (("some", given), ("none", [])):
        folder = tmp_path / name
        df = rows([(*d, "en", "s", 0, 1, "r") for d in data], schema)
        df.write.parquet(str(folder / "documents.parquet"))
        bins = corpus_pipeline.run(spark, str(folder)).collect()
        ids = {i for b in bins for i in b.doc_ids}
        assert ids == ({3, 5} if data else set())
