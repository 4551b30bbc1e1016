"""Corpus preparation from raw documents to packed sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plenum.llm import compression_quality, mixing, ngram_join, packing, secrets
from plenum.llm.common import Scratch, clean, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; null and empty texts have the prior's score, and without a model all stay."""
    return compression_quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that the n-gram Jaccard join connects, exactly one stays: that with the smallest doc_id, null last. Rows without words all stay."""
    return ngram_join.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become a mark; n_chars follows. Every row stays, null texts stay null."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them; those without words as their source's whole copies."""
    return mixing.resampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there; null and empty texts are the end id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The first stage learns a model and the last one tokenizes, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written to the shared folder before the next reads them.

    Nulls, repeated rows and an empty table go through as the stages say; extra columns of documents stay until the
    last one. What a stage left in the shared folder goes when its rows are written.
    """
    others = set(Scratch.made)
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs, f"stage{k}")
            clean(spark, scratch.root, *others)
            if k:
                scratch.drop(f"stage{k - 1}")
    return docs
