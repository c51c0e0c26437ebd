"""Mixing sources to target weights, in DataFrame operations only.

Targets. Source weights share a budget; a source whose share passes its limit
(``most_epochs`` times its size) stops there and the excess goes to the others by
weight. That is water filling: with sources in order of limit over weight, a
prefix stops and the level of the rest follows from two running sums.

Documents. Complete epochs take every document of a source; the words still
missing are drawn by Efraimidis-Spirakis keys -ln(u)/w, u from a hash of the
document's id, w its quality weight, in ascending order until a running sum of
sizes fills the budget. Keys are first summed in fine steps, so that only the one
step in which a source's budget ends has to be sorted, however large the
source. The document at the edge is taken if that brings the sum nearer.

Weights. By default the mean word length gives a document's quality, as it is known for every
document, while labels cover some only; ``weight`` takes any other column expression.

Null texts have size 0. Repeated rows and ids are rows of their own; null ids draw by the hash of
their text. Sources are ordered by code point, null last; equal keys are taken in order of id, then of
the text's hash. Empty tables give empty results. The plan over the sources (one row each) is made in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeloom.llm.common import WORD_PATTERN, cut, fresh

WEIGHTS = (5.0, 2.0, 1.0)
#: Steps of the key's distribution in which sizes are summed first.
STEPS = 4096
#: Source tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Weight 0.25 to 1 from the mean word length: prose words of 3 to 10 characters count in full."""
    mean = F.char_length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(3, 10), 1.0).when(mean.between(2, 20), 0.5).otherwise(0.25)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most_epochs: int = 2) -> DataFrame:
    """source, source_size -> and weight, target. One row per source."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(ordered) - 1) % len(weights) + 1
    weighted = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place)).withColumn("limit", F.col("source_size") * F.lit(float(most_epochs)))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    up = rising.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(1))
    level = weighted.select(
        "*",
        F.row_number().over(rising).alias("place"),
        F.coalesce(F.sum("limit").over(up), F.lit(0.0)).alias("stopped"),
        (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(up), F.lit(0.0))).alias("open"),
        (F.sum("source_size").over(all_) * F.lit(float(share))).alias("budget"),
    ).withColumn("own", (F.col("budget") - F.col("stopped")) / F.col("open"))
    # the first source in this order that does not stop sets the level
    lowest = F.min(F.when(F.col("own") * F.col("weight") <= F.col("limit"), F.struct("place", "own"))).over(all_)["own"]
    return level.withColumn("level", lowest).select("source", "source_size", "weight", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def sized(docs: DataFrame, seed: int = 17, weight: Column | None = None) -> DataFrame:
    """Narrow table of all rows: doc_id, source, size, key (ascending draw order), step. weight: a positive column of docs in place of ``quality``."""
    weight = quality(F.col("text"), words(F.col("text"))) if weight is None else weight
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words(F.col("text")).alias("size"), F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.xxhash64("text").cast("string"))), F.lit(f":{seed}")).cast("binary"), 256).alias("h"), F.xxhash64("text").alias("tie"), weight.alias("weight"))
    u = (F.coalesce(F.conv(F.substring("h", 1, 13), 16, 10).cast("long"), F.lit(0)) + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = base.select("doc_id", "source", "size", "tie", (-F.log(u) / F.coalesce("weight", F.lit(0.25))).alias("key"))
    return keyed.withColumn("step", F.floor((1 - F.exp(-F.col("key"))) * STEPS).cast("int"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most_epochs: int = 2, seed: int = 17, weight: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, times: how often the mix takes each row of docs."""
    rows = cut(sized(docs, seed, weight))
    steps = rows.groupBy("source", "step").agg(F.sum("size").alias("size"))
    steps = cut(steps)
    plan = targets(steps.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most_epochs)
    plan = plan.withColumn("epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) + F.lit(1e-12)).cast("long"))
    plan = plan.withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = steps.withColumn("before", before).withColumnRenamed("source", "of")
    edge = edge.join(plan, F.col("of").eqNullSafe(F.col("source"))).where("before <= rest and before + size > rest").groupBy("source").agg(F.min("step").alias("edge"), F.min_by("before", "step").alias("before"))
    edge = edge.withColumnRenamed("source", "of")
    plan = cut(plan.join(edge, F.col("of").eqNullSafe(F.col("source")), "left").select(F.col("source").alias("of"), "source_size", "target", "epochs", "rest", F.coalesce("edge", F.lit(-1)).alias("edge"), F.coalesce("before", F.lit(0)).alias("before")))
    few = plan.count() <= BROADCAST_SOURCES
    all_rows = rows.join(F.broadcast(plan) if few else plan, F.col("source").eqNullSafe(F.col("of")))
    # budget used up at the end of the last step: every document of size 0 beyond the edge stays out
    clear = all_rows.where("step <> edge").withColumn("more", F.when(F.col("edge") >= 0, F.col("step") < F.col("edge")).otherwise(F.col("rest") > 0).cast("long"))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0))
    at_edge = all_rows.where("step = edge").withColumn("run", F.col("before") + run)
    at_edge = at_edge.withColumn("more", (F.col("run") - F.col("size") / 2 <= F.col("rest")).cast("long")).drop("run")
    drawn = clear.unionByName(at_edge).withColumn("times", F.col("epochs") + F.when(F.col("epochs") < most_epochs, F.col("more")).otherwise(F.lit(0)))
    return drawn.select("doc_id", "tie", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """Rows of docs as often as the mix takes them, with all their columns. Texts are shuffled once; rows of one id are told apart by their texts' 64-bit hashes."""
    known, missing, tie, total, rows, copy = fresh(docs, "_row_id", "_row_null", "_row_tie", "_mix_sum", "_mix_rows", "_mix_copy")
    key = lambda c: {known: F.coalesce(c.cast("long"), F.lit(0)), missing: c.isNull()}
    times = mix(docs, **how).withColumns(key(F.col("doc_id"))).groupBy(known, missing, F.col("tie").alias(tie)).agg(F.sum("times").alias(total), F.count("*").alias(rows)).where(F.col(total) > 0)
    joined = docs.withColumns({tie: F.xxhash64("text"), **key(F.col("doc_id"))}).join(times, [known, missing, tie])
    # rows equal in id and text take their sum in turn
    turn = F.row_number().over(Window.partitionBy(known, missing, tie).orderBy(F.col("source").asc_nulls_last()))
    own = F.floor(F.col(total) / F.col(rows)) + (turn <= F.col(total) % F.col(rows)).cast("long")
    repeated = joined.withColumn(copy, own.cast("int")).where(F.col(copy) > 0)
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*[F.col(f"`{c}`") for c in docs.columns])
