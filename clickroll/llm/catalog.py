"""Registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html_extract, language_id, merkle, mixing, periodic_runs, pii, quality_rules, secret_scan, simhash, vector_codes, warc
from . import quality_classifier as qc
from . import spans as S
from .common import table, text_of


def tokenizer_path() -> str:
    """The byte-level vocabulary; any other file of that kind may be passed to bpe.encode."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(sf_dir, "documents", spark)
    text = text_of("text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    order = quality_rules.rule_order(docs)
    # the query returns the base counts, so only the other counts are left to the cascade
    rows = docs.select("doc_id", text.alias("text"), *[quality_rules.COUNTS[c](text).alias(c) for c in base])
    counts = {c: F.col(c) if c in base else f(F.col("text")) for c, f in quality_rules.COUNTS.items()}
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", *base, failed.alias("base_failed"),
                       F.when(failed, F.lit(False)).otherwise(quality_rules.verdict(order, counts).isNull()).alias("kept"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(sf_dir, "pages", spark))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edits(table(sf_dir, "documents", spark))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(sf_dir, "pages", spark))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(sf_dir, "documents", spark)).select(
        "doc_id", *[S.count(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"), S.joined(F.col("found")).alias("spans"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(sf_dir, "documents", spark), tokenizer_path())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(sf_dir, "documents", spark)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = pii.find(table(sf_dir, "documents", spark))
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    return hits.select(
        "doc_id", *[S.count(F.col("found"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(S.joined(base), 256).alias("base_sha256"), S.joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(sf_dir, "documents", spark)
    rows = qc.training_rows(docs, table(sf_dir, "labels", spark), usable=~qc.held_out(F.col("doc_id")))
    scored = qc.score(docs, qc.fit(rows))
    return scored.select("doc_id", qc.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= qc.THRESHOLD).cast("int").alias("predicted"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(sf_dir, "documents", spark)).select(
        "doc_id", "fingerprint", "component_id")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(sf_dir, "documents", spark))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(sf_dir, "documents", spark), plant=True)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(sf_dir, "embeddings", spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_html_extract, op3_bpe, op4_fingerprints, op5_mixing, op6_pii, op7_quality_classifier,
        op8_warc, op9_simhash, op10_secret_scan, op11_language_id, op12_periodic_runs, op13_vector_codes)}
