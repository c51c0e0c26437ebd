"""Sinks: cleaned pages as files, audit reports, registry and usage tables.

Pages are written by the tasks that hold them, each under a temporary name of its attempt
and renamed when complete, so a task that runs again replaces a file by an equal one. Tables of any
size are written by Spark's own writers; only reports, which are read by people, are single files.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeloom.operators import audit
from nodeloom.sources.registry import REGISTRY_HEADERS


def store(uri: str):
    """Arrow file system and path for a URI or a local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_table(cleaned: DataFrame, folder: str) -> None:
    """Cleaned pages (municipality, filename, html) as a partitioned table."""
    cleaned.write.mode("errorifexists").partitionBy("municipality").parquet(folder)


def write_pages(cleaned: DataFrame, folder: str, overwrite: bool = True, dry_run: bool = False) -> DataFrame:
    """municipality, filename, path, bytes, written of cleaned pages (municipality, filename, html): one UTF-8 file a page under the municipality's folder.

    An existing file is replaced, or left alone where ``overwrite`` is off; a dry run writes nothing. Names are taken as plain names: what looks like a folder is not one.
    The rows are made as the result is read, once for each reading.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        attempt = TaskContext.get().taskAttemptId()
        plain = lambda s: (s or "").replace("/", "_").replace("\\", "_")
        for batch in batches:
            rows = []
            for town, name, html in zip(*(c.to_pylist() for c in batch.columns)):
                data, path = (html or "").encode("utf-8", "surrogatepass"), f"{root}/{plain(town)}/{plain(name)}"
                write = not dry_run and (overwrite or files.get_file_info(path).type.name == "NotFound")
                if write:
                    files.create_dir(f"{root}/{plain(town)}", recursive=True)
                    with files.open_output_stream(f"{root}/{plain(town)}/_tmp-{attempt}-{plain(name)}", compression=None) as out:
                        out.write(data)
                    files.move(f"{root}/{plain(town)}/_tmp-{attempt}-{plain(name)}", path)
                rows.append((town, name, path, len(data), write))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()))], names=["municipality", "filename", "path", "bytes", "written"])

    return cleaned.select(F.col("municipality").cast("string"), "filename", "html").mapInArrow(run, "municipality string, filename string, path string, bytes long, written boolean")


def _line(values) -> str:
    out = io.StringIO()
    csv.writer(out).writerow(values)
    return out.getvalue()


def _write_lines(path: str, lines: Iterator[str]) -> None:
    files, at = store(path)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(f"{at}.tmp", compression=None) as out:
        for line in lines:
            out.write(line.encode())
    files.move(f"{at}.tmp", at)


COLUMNS = ("file", "severity", "rule_id", "line", "message", "snippet", "suggestion")


def write_audit(report: DataFrame, metrics: DataFrame, noise: DataFrame, md_path: str, csv_path: str) -> str:
    """Audit as CSV and Markdown from report rows (``audit.report``), metrics (file, tables, ...) and noise (file, noise, n); the verdict is returned.

    Rows come to the driver in order, one partition at a time.
    """
    ordered = report.orderBy(audit.rank(), "file", F.coalesce("line", F.lit(0)), "rule_id", "message").select(*COLUMNS)
    rows = lambda df: ([r[c] if r[c] is not None else "" for c in df.columns] for r in df.toLocalIterator())
    _write_lines(csv_path, _chain([_line(COLUMNS)], (_line(r) for r in rows(ordered))))
    totals = {r["severity"]: r["count"] for r in report.groupBy("severity").count().collect()}  # one row a severity
    status = "FAIL" if totals.get("Critical") or totals.get("High") else "PASS"
    by_file = report.groupBy("file").agg(*[F.sum((F.col("severity") == s).cast("long")).alias(s) for s in audit.SEVERITIES])
    files = metrics.select("file").join(by_file, "file", "left").fillna(0).orderBy("file")
    cell = lambda v: str(v).replace("|", "\\|").replace("\n", " ")
    table = lambda df: (f"| {' | '.join(map(cell, r))} |\n" for r in rows(df))
    head = lambda names: f"| {' | '.join(names)} |\n|{' --- |' * len(names)}\n"

    def lines() -> Iterator[str]:
        yield f"# Output HTML quality audit\n\n- status: {status}\n- files: {metrics.count()}\n" + "".join(f"- {s.lower()}: {totals.get(s, 0)}\n" for s in audit.SEVERITIES)
        yield "\n## Files\n\n" + head(["file", *[s.lower() for s in audit.SEVERITIES]])
        yield from table(files)
        for s in audit.SEVERITIES:
            yield f"\n## {s} issues\n\n"
            if totals.get(s):
                yield head([c for c in COLUMNS if c != "severity"])
                yield from table(ordered.where(F.col("severity") == s).drop("severity"))
            else:
                yield "No issues.\n"
        yield "\n## Table metrics\n\n" + head(metrics.columns)
        yield from table(metrics.orderBy("file"))
        yield "\n## Repeated noise\n\n"
        found = False
        for r in noise.orderBy("file", "noise").toLocalIterator():
            found = True
            yield f"- {r['file']}: {r['noise']} x {r['n']}\n"
        if not found:
            yield "No repeated noise.\n"

    _write_lines(md_path, lines())
    return status


def _chain(*parts) -> Iterator[str]:
    for part in parts:
        yield from part


def write_registry(rows: DataFrame, path: str) -> None:
    """Registry rows as one CSV file with a byte order mark and the registry's headers, in the order of their file names."""
    ordered = rows.orderBy(F.col(f"`{REGISTRY_HEADERS[2]}`")).select(*[F.col(f"`{h}`") for h in REGISTRY_HEADERS])
    _write_lines(path, _chain(["\ufeff" + _line(REGISTRY_HEADERS)], (_line(["" if v is None else v for v in r]) for r in ordered.toLocalIterator())))


def append_usage(entries: DataFrame, folder: str) -> None:
    """Append usage rows to the log table."""
    entries.write.mode("append").parquet(folder)


def page_summary(usage: DataFrame) -> DataFrame:
    """page_id, step, calls, tokens, place (steps of a page by tokens, most first) of usage (page_id, step, calls, tokens): steps without tokens are left out."""
    from pyspark.sql import Window

    summed = usage.groupBy("page_id", "step").agg(F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens")).where("tokens > 0")
    return summed.withColumn("place", F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("tokens").desc(), "step")))
