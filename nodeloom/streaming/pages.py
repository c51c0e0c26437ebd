"""New pages as a stream: an extension of the batch operators, which have no streams of their own to match.

Files that arrive in a folder of captured pages are shredded as they come. Shredding
is stateless, so late or repeated files need no watermark; ``fresh_only`` drops
pages seen before within a window of event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeloom.operators import audit, detect
from nodeloom.operators.shred import shred

PAGES = "page_id long, url string, html string, fetched_at timestamp"


def stream_pages(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def fresh_only(pages: DataFrame, window: str = "1 day") -> DataFrame:
    """The first copy of a page within the window; state older than it is let go."""
    return pages.withWatermark("fetched_at", window).dropDuplicatesWithinWatermark(["url"])


def stream_nodes(pages: DataFrame) -> DataFrame:
    return shred(pages)


def findings_sink(pages: DataFrame, folder: str, checkpoint: str):
    """Write the findings and table issues of each batch; a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        nodes = shred(batch)
        found = detect.findings(nodes).select("page_id", "rule_id", F.col("summary").alias("message"))
        issues = audit.table_issues(nodes).select("page_id", "rule_id", "message")
        found.unionByName(issues).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
