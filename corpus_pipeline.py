"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all documents that the one before kept. Quality rules reject documents; line dedup
takes out lines that match an earlier one, and with them documents of which nothing is left; near-dedup
keeps one document of each group; secret scans put a mark in place of each secret; packing returns a row
per bin, with the documents in it.

Null, empty and blank texts don't pass the quality rules. Extra columns are carried up to packing.
"""

from __future__ import annotations

from pubweave.llm import lines, minhash, packing, quality, secrets
from pubweave.storage import discard, store
from pyspark.sql import DataFrame, SparkSession


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.train(secrets.labelled_tokens(docs)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Compression ratios, trained models and packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of the last stage; what a stage returns is written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = None
    for name, stage in STAGES:
        made = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if path:
            discard(spark, path)
        docs, path = made.table, made.path
    return docs
