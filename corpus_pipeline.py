"""Corpus pipeline: quality classifier, SimHash near-dedup, PII, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and rereads it as the next stage's docs. All but the last
stage return the columns of documents. Edge cases are the operators' (see their modules):
missing and empty texts pass the privacy and mixing stages unchanged, equal rows are
near-duplicates of each other, empty input stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm import bpe, mixing, pii, simhash
from clickroll.llm import quality_classifier as qc
from clickroll.llm.catalog import tokenizer_path
from clickroll.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns as the query of its own does."""
    rows = qc.training_rows(docs, table(sf_dir, "labels", spark), usable=~qc.held_out(F.col("doc_id")))
    return qc.keep_good(docs, qc.fit(rows))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; n_chars follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, repeats included."""
    return mixing.mixed_rows(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, one row a mixed row."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: trained weights, bit-vote fingerprints and tokeniser merges have no SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(sf_dir, "documents", spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
