"""A corpus pipeline over ``documents``: each stage works on all that the one before kept.

Toxic documents go; documents that fail the quality rules go, and the others lose the lines that too many
documents of their host share; of near copies one stays; secrets are masked; what is left is packed into
sequences of tokens. Every stage is written as Parquet to the cluster's shared folder and read again, so a lost
executor costs at most the stage at hand.

All stages: an empty table gives an empty one; other columns than the text and its length stay as they are, whatever
their names; repeated rows are judged each for itself, and rows with a null id like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirewire.llm import packing, quality, secret_scan, simhash, toxicity
from hirewire.llm.common import table, written
from hirewire.llm.tokens import public_path

SEQUENCE = 1024
END_ID = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; the model learns from the labelled ones among them. Null and empty
    texts count as one clean token; without usable labels nothing goes."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their host's common lines. Null, empty and blank texts fail; null
    sources are one host."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies; null ids come last, and of rows with the
    smallest id the first one of the table stays. Texts without a word are copies of each other."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=2, seed=42)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; null texts stay null."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences; null and empty texts are the end id alone."""
    return packing.pack_documents(docs, public_path("byte_bpe_50k.json"), END_ID, SEQUENCE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_copies),
                                   ("secrets", mask_secrets), ("packing", pack)]

#: Several stages (the trained models, the tokenizer) have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` below ``sf_dir``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
