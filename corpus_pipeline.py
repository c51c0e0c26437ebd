"""From raw documents to training tokens: five stages, each of which calls one operator of nodeloom.llm.

Each stage takes the rows that the stage before kept, is written as Parquet and
read again. All but the last return the columns of ``documents``; the last returns
the tokens of every row that is left (a document that the mix repeats is a row
each time).

Null texts have no letter and go in the first stage; null ids, repeated rows, extra columns and
empty tables pass each stage as its operator's docstring says (of rows with one id and text one stays;
an empty table gives an empty result). The stages' files go when the session ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nodeloom.llm import bpe, exactdedup, langid, mixing, simhash
from nodeloom.llm.common import scratch
from nodeloom.llm.queries import default_tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without one language for half of their letters, go."""
    return langid.keep_known(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exactdedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source targets take them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return bpe.digests(docs, default_tokenizer())


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", tokens)]

#: No stage but the second can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
