"""The registered queries of this subpackage: each applies one operator to its whole table and derives
the columns that its contract names."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pubweave.llm import (
    bpe,
    chat,
    lines,
    merkle,
    minhash,
    ngrams,
    packing,
    pivots,
    quality,
    runs,
    secrets,
    substrings,
    urls,
)
from pubweave.llm.common import SEPARATORS, read

VOCABULARY = "byte_bpe_50k.json"
URL_RULES = (
    urls.Rule("com/", urls.ALLOW),
    urls.Rule("example.com/en/", urls.BLOCK),
    urls.Rule("www.example.com/en/", urls.ALLOW),
    urls.Rule("net/es/", urls.BLOCK),
    urls.Rule("net/fr/", urls.BLOCK),
)
#: Host parts whose URLs are labelled as unwanted, for training.
UNWANTED = ("ads", "adult", "bets", "casino", "farm", "pills", "spam")
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.placed(packing.pack(read(spark, sf_dir, "documents"), texts=False))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.train(urls.label_by_hosts(pages, UNWANTED))
    return urls.filter_urls(pages, URL_RULES, model)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.lines_report(read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngrams.score_documents(read(spark, sf_dir, "documents"))
    rounded = {c: F.round(c, 6) for c in ("log_score", "mean_log_score")}
    return scored.withColumns(rounded)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_tokens(docs))
    found = secrets.find_secrets(docs, model).select("doc_id", "secrets.base", "secrets.spans")

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(secrets.BASE)),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    formatted = chat.format_records(chat.gather(rows.unionByName(control)), given="given")
    out = formatted.select(
        "conv_id",
        "layout",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read(spark, sf_dir, "embeddings"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth text, by the CRC of its ``doc_id``, repeats from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SEPARATORS), lambda w: w != "")
    n, g = F.size("words"), F.floor(F.col("crc") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.array_join(
        F.transform("words", lambda _, i: F.get("words", source(i))), " "
    )
    chosen = (F.col("crc") % 10 == 0) & (n > 0)
    given = docs.withColumn("crc", crc).withColumn("words", F.when(F.col("crc") % 10 == 0, words))
    parts = given.withColumn("a", F.when(chosen, a)).withColumn("p", F.when(chosen, p))
    return parts.withColumn("text", F.when(chosen, repeated).otherwise(F.col("text"))).select("doc_id", "text")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(made_periodic(read(spark, sf_dir, "documents")))
    best = runs.longest_run(F.col("runs"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("cleaned.kept", 256).alias("collapsed_sha256"),
    )
    length, period = F.col("best.length"), F.col("best.period")
    return listed.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    letters = string.ascii_uppercase
    lowered = {"text": F.translate("text", letters, letters.lower())}
    leaf = merkle.row_digest([F.col(c) for c in merkle.FIELDS])
    other = merkle.row_digest([lowered.get(c, F.col(c)) for c in merkle.FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, other).alias("tampered"))
    made = merkle.build(rows, "leaf", "lang", "doc_id")
    root = F.lit(made.root).cast("string")
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.drop_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "cleaned.n_words", "cleaned.n_removed", F.sha2("cleaned.kept", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_url_filters": op2_url_filters,
    "op3_line_dedup": op3_line_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_secret_scans": op5_secret_scans,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_substring_dedup": op13_substring_dedup,
}
