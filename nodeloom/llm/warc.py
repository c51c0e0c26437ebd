"""WARC archives: a deterministic sharded writer and a reader.

Writing. Rows are dealt into ranges of page_id and sorted; each range's records are written
one gzip member at a time into files of its own, which roll once the compressed size
passes ``roll_bytes``, and give a manifest row each. The ranges follow from the pages alone
(``range_bounds``: an exact histogram of bytes over ids, refined where it is heavy), not
from the cluster, a sample or a setting. Headers, record ids and digests are regenerated
from the page (no clock, no host), so the same pages always give the same files, byte by
byte. A file is written under a temporary name of its task attempt and renamed when
complete: a task that runs again replaces a file by an equal one. The manifest is written
in parts under a temporary name, renamed, and then named by a small marker file, which is
renamed into place last; readers follow the marker and so see all files of a finished write
or none.

Records of equal payload: the one of the smallest page_id is a ``response``, the
others are ``revisit`` records that refer to it; payloads of fewer than
``revisit_from`` bytes are always responses. Which page refers to which is worked
out on digests and ids; the payloads themselves are moved once, by range.

Null html counts as an empty payload, null urls as empty. Rows that repeat the page_id
of a response are responses too. Null page_ids are written first. Rows of one page_id, and
of null ids, share a range. An empty table gives a manifest without files; other columns are ignored.

Paths are URIs of the shared folder (file, hdfs, s3 and others that Arrow opens).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeloom.llm.common import bound_batches, cut, join_split, numbers, place_among, scratch

#: Bytes of html that a range is meant to hold at most, and the least number of ranges (while they have a MB each).
RANGE_BYTES, RANGES_LEAST = 1 << 30, 32
#: Compressed bytes at which a file rolls at most; less where an eighth of the range's html is less.
ROLL_BYTES = 128 << 20
#: Steps of ids in one pass of the histogram, and compressed bytes that one task reads back.
STEPS, READ_BYTES = 1 << 14, 64 << 20
#: Date of every record (fixed, as it is part of the bytes).
DATE = "2000-01-01T00:00:00Z"
MANIFEST, MARKER = "manifest", "manifest.json"


def store(uri: str):
    """Arrow file system and path for a URI or a local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}").urn


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: headers, block and the two line ends behind it."""
    digest = base32_sha1(payload)
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{record_id(refers_to, digest)}>"), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6, mtime=0, filename="") as f:
        f.write(data)
    return out.getvalue()


class Shard:
    """Files of one range, rolled by compressed size; named by range and number."""

    def __init__(self, folder: str, part: int, attempt: int, roll_bytes: int):
        self.files, self.folder = store(folder)
        self.part, self.attempt, self.roll = part, attempt, roll_bytes
        self.n, self.out, self.done = 0, None, []

    def add(self, page_id: int | None, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:05d}-{self.n:05d}.warc.gz"
            self.temporary = f"{self.folder}/_tmp-{self.name}-{self.attempt}"
            self.out = self.files.open_output_stream(self.temporary, compression=None)
            self.bytes, self.records, self.sha, self.first = 0, 0, hashlib.sha256(), page_id
        data = member(data)
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += 1
        self.last = page_id
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.records, self.bytes, self.sha.hexdigest(), self.first, self.last))
            self.n, self.out = self.n + 1, None


def measured(pages: DataFrame) -> DataFrame:
    """page_id, digest, bytes of each payload: the narrow table that references and ranges are worked out on."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return cut(pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")), compact=True)


def references(narrow: DataFrame, revisit_from: int = 0) -> DataFrame:
    """page_id, refers_to, digest of the pages that become revisits. Payloads of very many pages are settled by broadcast."""
    marked = narrow.where(F.col("bytes") >= revisit_from).select("page_id", "digest")
    first = cut(marked.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1"))
    return join_split(marked, first, "digest", marked.count()).where("page_id <> refers_to").select("page_id", "refers_to", "digest").distinct()


def range_bounds(narrow: DataFrame, range_bytes: int) -> list[int]:
    """Ascending page_ids at which a new range begins.

    Bytes are summed over even steps between the least and the largest id; steps of more than
    ``range_bytes`` are cut into steps again, until a step is light or a single id. Then steps are packed in
    order. The driver holds one number for each step that has pages: STEPS, and STEPS more for each heavy one.
    """
    least, most = narrow.agg(F.min("page_id"), F.max("page_id")).first()
    if least is None:
        return []
    todo, light = [(least, most + 1)], []  # heavy intervals, light steps with their bytes
    while todo:
        starts, widths = [a for a, _ in todo], [max(1, -(-(b - a) // STEPS)) for a, b in todo]
        ends = [b for _, b in todo]
        at = place_among(len(starts), lambda i: F.get(numbers(starts), i) <= F.col("page_id"))  # noqa: B023  called at once
        inside = narrow.where("page_id is not null").select("page_id", "bytes", at.alias("k")).where((F.col("k") >= 0) & (F.col("page_id") < F.get(numbers(ends), F.col("k"))))
        step = F.floor((F.col("page_id") - F.get(numbers(starts), F.col("k"))) / F.get(numbers(widths), F.col("k"))).cast("long")
        found = inside.groupBy("k", step.alias("step")).agg(F.sum("bytes").alias("bytes")).collect()
        todo = []
        for r in found:
            a = starts[r["k"]] + r["step"] * widths[r["k"]]
            if r["bytes"] > range_bytes and widths[r["k"]] > 1:
                todo.append((a, min(a + widths[r["k"]], ends[r["k"]])))
            else:
                light.append((a, r["bytes"]))
        todo.sort()
    bounds, held = [], 0
    for a, size in sorted(light):
        if not bounds or (held and held + size > range_bytes):
            bounds.append(a)
            held = 0
        held += size
    return bounds


def write(pages: DataFrame, folder: str, roll_bytes: int | None = None, revisit_from: int = 0, range_bytes: int | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as archives in a new folder and return its manifest: file, records, bytes, sha256, first_id, last_id."""
    spark = pages.sparkSession
    bound_batches(spark)
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    narrow = measured(pages)
    size = narrow.agg(F.sum("bytes")).first()[0] or 0
    range_bytes = range_bytes or min(RANGE_BYTES, max(1 << 20, size // RANGES_LEAST))
    roll_bytes = roll_bytes or min(ROLL_BYTES, range_bytes // 8)
    bounds = range_bounds(narrow, range_bytes)
    nothing = F.lit(None).cast("string")
    revisits = references(narrow, revisit_from).select("page_id", nothing.alias("url"), nothing.alias("html"), "refers_to", "digest", F.lit(0).alias("kind"))
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.lit(None).cast("long").alias("refers_to"), F.sha1(html.cast("binary")).alias("digest"), F.lit(1).alias("kind"))
    at = F.greatest(place_among(len(bounds), lambda i: F.get(numbers(bounds), i) <= F.col("page_id")), F.lit(0))
    # a page's reference sorts just before the page
    dealt = rows.unionByName(revisits).withColumn("range", at).repartitionById(max(1, len(bounds)), F.col("range")).sortWithinPartitions("range", F.col("page_id").asc_nulls_first(), "kind", "url", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        shard, done = None, []
        known: dict[str, int] = {}
        known_of = None
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                for page_id, url, text, refers_to, digest, kind, part in zip(*(c.to_pylist() for c in batch.slice(i, 64).columns)):
                    if shard is None or shard.part != part:
                        if shard is not None:
                            shard.close()
                            done += shard.done
                        shard = Shard(folder, part, attempt, roll_bytes)
                    if page_id != known_of:
                        known, known_of = {}, page_id
                    if kind == 0:
                        known[digest] = refers_to
                    else:
                        shard.add(page_id, record(page_id, url, text.encode("utf-8", "surrogatepass"), known.get(digest)))
        if shard is not None:
            shard.close()
            done += shard.done
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["file", "records", "bytes", "sha256", "first_id", "last_id"])

    schema = "file string, records long, bytes long, sha256 string, first_id long, last_id long"
    manifest = cut(dealt.mapInArrow(run, schema), compact=True)
    manifest.orderBy("file").write.json(f"{folder}/_tmp-{MANIFEST}")
    files.move(f"{path}/_tmp-{MANIFEST}", f"{path}/{MANIFEST}")
    total = manifest.agg(F.count("*").alias("files"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes")).first().asDict()
    with files.open_output_stream(f"{path}/_tmp-{MARKER}") as out:
        out.write(json.dumps(total | {"manifest": MANIFEST, "range_bytes": range_bytes, "roll_bytes": roll_bytes, "ranges": len(bounds)}).encode())
    files.move(f"{path}/_tmp-{MARKER}", f"{path}/{MARKER}")
    return manifest


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each gzip member of an archive, one at a time."""
    inflate, held, raw = zlib.decompressobj(31), bytearray(), b""
    while True:
        raw = raw or stream.read(1 << 20)
        if not raw:
            break
        held += inflate.decompress(raw)
        raw = inflate.unused_data if inflate.eof else b""
        if inflate.eof:
            end = held.index(b"\r\n\r\n")
            head = dict(line.split(": ", 1) for line in held[:end].decode().split("\r\n")[1:])
            block = bytes(held[end + 4 : end + 4 + int(head["Content-Length"])])
            yield head, block
            inflate, held = zlib.decompressobj(31), bytearray()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record of the archives that the manifest lists: page_id, url, record_type, payload_bytes, payload_digest, refers_to, html (null for revisits). Digests are verified."""
    files, path = store(folder)
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string"
    with files.open_input_stream(f"{path}/{MARKER}") as marker:
        total = json.loads(marker.read())
    # about READ_BYTES a task, and no fewer tasks than there are cores, as far as there are files
    tasks = min(total["files"], max((total["bytes"] or 0) // READ_BYTES, 4 * spark.sparkContext.defaultParallelism))
    names = spark.read.schema("file string").json(f"{folder}/{total['manifest']}").repartition(max(1, tasks), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "html"])
        files, path = store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for head, block in records(stream):
                        digest, kind, html = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], None
                        if base32_sha1(block) != head["WARC-Block-Digest"].removeprefix("sha1:"):
                            raise ValueError(f"{name}: block digest of {head['WARC-Record-ID']} differs")
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if base32_sha1(payload) != digest:
                                raise ValueError(f"{name}: payload digest of {head['WARC-Record-ID']} differs")
                            html = payload.decode("utf-8", "surrogatepass")
                        number = lambda k: int(head[k]) if head.get(k) else None  # noqa: B023, E731
                        rows.append((number("X-Page-Id"), head["WARC-Target-URI"], kind, number("X-Payload-Length"), digest, number("X-Refers-To-Page-Id"), html))
                        size += len(block)
                        if len(rows) >= 512 or size > 4 << 20:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)

    return names.select("file").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared checkpoint folder and read them back; the archives go with the session."""
    folder = scratch(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder)
