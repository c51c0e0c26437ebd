"""Exact dedup with a heavy-hitter split, in DataFrame operations only.

1. Each row gets the SHA-256 of its normalised text (A-Z lower-cased, null as
   empty) and a row number; this narrow table is checkpointed, texts are not moved.
2. Misra-Gries counters (``freqItems``) propose the digests that may hold more than
   ``support`` of all rows: at most 1/support candidates, none missed.
3. Their rows are counted exactly; the candidates that do pass become winners with
   the row that stays. This table is bounded by 1/support rows and is broadcast, so
   rows of frequent texts are settled where they are read.
4. All other digests go through one ordinary shuffle. None of them holds more than
   ``support`` of the rows.

Of rows with equal texts and equal doc_id (repeated rows) exactly one stays.
Null ids sort below all others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeloom.llm.common import ascii_lower, cut, fresh

SUPPORT = 1e-3


def normalised(text):
    return ascii_lower(F.coalesce(text, F.lit("")))


def digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))


def frequent(rows: DataFrame, support: float) -> DataFrame:
    """Verified winners: text_sha256, keep (the row that stays), group_size. At most 1/support rows."""
    total = rows.count()
    proposed = rows.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    counted = rows.join(F.broadcast(proposed), "text_sha256").groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    return cut(counted.where(F.col("group_size") > F.lit(support) * F.lit(total)))


def exact_duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of docs."""
    rows = cut(digests(docs).withColumn("row", F.monotonically_increasing_id()))
    return settled(rows, frequent(rows, support))


def settled(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """exact_duplicates of numbered digests: rows of winners by broadcast, the others through one shuffle."""
    marked = rows.join(F.broadcast(winners), "text_sha256", "left")
    same = Window.partitionBy("text_sha256")
    rest = marked.where("group_size is null").select("text_sha256", "doc_id", "row")
    rest = rest.select("*", F.max(F.struct("doc_id", "row")).over(same).alias("keep"), F.count("*").over(same).alias("group_size"))
    all_ = marked.where("group_size is not null").select(*rest.columns).unionByName(rest)
    return all_.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Rows of docs whose text stays, with all their columns; of repeated rows of one id and text, one.

    The broadcast winners send rows of frequent texts away where they are read; what is
    left is shuffled once, to meet the narrow table of rows that stay.
    """
    digest, known, missing, nth, hot_digest, hot_id = fresh(docs, "_row_digest", "_row_id", "_row_null", "_nth", "_hot_digest", "_hot_id")
    rows = cut(digests(docs).withColumn("row", F.monotonically_increasing_id()))
    winners = frequent(rows, support)
    key = [F.coalesce(F.col("doc_id"), F.lit(0)).alias(known), F.col("doc_id").isNull().alias(missing), F.col("text_sha256").alias(digest)]
    stays = settled(rows, winners).where("kept").select(*key)
    left = docs.withColumns({digest: F.sha2(normalised(F.col("text")).cast("binary"), 256), known: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), missing: F.col("doc_id").isNull()})
    of_hot = winners.select(F.col("text_sha256").alias(hot_digest), F.col("keep.doc_id").alias(hot_id))
    left = left.join(F.broadcast(of_hot), F.col(digest) == F.col(hot_digest), "left")
    left = left.where(F.col(hot_digest).isNull() | F.col("doc_id").cast("long").eqNullSafe(F.col(hot_id))).drop(hot_digest, hot_id)
    joined = left.join(stays, [digest, known, missing], "left_semi")
    # repeated rows of one id and one text both meet their digest's row: one of them is enough
    first = F.row_number().over(Window.partitionBy(digest, known, missing).orderBy("doc_id"))
    return joined.withColumn(nth, first).where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
