"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Texts handed to Python at once; the rest of an Arrow batch waits in Arrow form.
ROWS_AT_ONCE = 256


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir. Where it is unset, a local folder in local mode (tests) and an error elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{tempfile.gettempdir()}/nodeloom-checkpoints"
    return root.rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder for intermediates, which goes when the session's JVM ends."""
    path = f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(held)
    return path


def cut(df: DataFrame, compact: bool = False) -> DataFrame:
    """Materialise df once in the shared checkpoint folder and go on from there, so that no later stage depends on executors that may be lost.

    compact: gather the narrow results of many small tasks in one file a core.
    """
    spark = df.sparkSession
    df = df.repartition(spark.sparkContext.defaultParallelism) if compact else df
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts without multi-byte characters take Spark's ASCII fast path, which gives the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Bytes of rows that travel to a Python worker at once, unless the session says otherwise than by default.
BATCH_BYTES, BATCH_SETTING, BATCH_DEFAULT = "8m", "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64m", "64MB")


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small: a batch exists in the JVM and twice in the worker. Spark knows this limit as a setting of the session only, so it holds for the session from here on, unless the session has set its own."""
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT[0]) in BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def by_batch(df: DataFrame, schema: str, work: Callable[[list[list]], list[list]], setup: Callable[[], None] | None = None) -> DataFrame:
    """Run work(columns) -> columns over df in slices of ROWS_AT_ONCE rows through Arrow; nulls arrive as None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup:
            setup()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                out = work([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, fields, strict=True)], schema=fields)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def crc_fold(doc_id: Column) -> Column:
    """Fold 0 to 4 of a document: crc32 of the id as text, modulo 5. Fold 0 is held out of every fit."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has, whatever columns it brings along."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: A key with more than this share of all rows is settled by broadcast: at most 1/HOT_SHARE keys can have it.
HOT_SHARE = 1e-3


def join_split(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined to table (one row a key; its column ``n`` counts the rows of the key, and goes). Keys with more than HOT_SHARE of
    ``total`` rows are at most 1/HOT_SHARE; they are broadcast, so that no task meets all rows of one. The others are joined by shuffle."""
    hot = table.where(F.col("n") > F.lit(HOT_SHARE * total)).drop("n")
    cold = table.where(F.col("n") <= F.lit(HOT_SHARE * total)).drop("n")
    settled = rows.join(F.broadcast(hot), key)
    return settled.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def numbers(values: list[int]) -> Column:
    """A literal array<bigint>, however long, as one expression."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def place_among(size: int, at_most: Callable[[Column], Column]) -> Column:
    """Largest i in 0 .. size-1 for which at_most(i) holds, -1 if it holds for none; at_most holds up to some i and not beyond. A binary search."""
    halves = F.array(*[F.lit(1 << n) for n in range(max(1, size).bit_length() - 1, -1, -1)])
    return F.aggregate(halves, F.lit(-1), lambda at, step: F.when((at + step < size) & F.coalesce(at_most(at + step), F.lit(False)), at + step).otherwise(at))
