"""Queries over the driver's tables, one for each training-data operator, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeloom.llm import bpe, exactdedup, langid, license, license_sql, mixing, orderminhash, other_sql, pii, simhash, toxicity, warc
from nodeloom.llm.common import crc_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), default_tokenizer())


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.compare_neighbours(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_order_minhash": op2_order_minhash,
    "op3_simhash": op3_simhash,
    "op4_langid": op4_langid,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_license": op9_license,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": """
        with n as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        )
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from n
    """,
    "op7_warc": other_sql.warc_sql(),
    "op8_mixing": other_sql.mixing_sql(),
    "op9_license": license_sql.scan_sql(),
}
