"""Operator 4, a deterministic sharded WARC writer and its reader.

Writing takes two passes over the pages. The first keeps (id, digest, size) only:
from it come the ranges of ids, cut at equal payload bytes, and the payloads
that occur more than once. The second deals the pages to their ranges, sorts each,
and writes it record by record as gzip members; a file is closed when its
compressed size reaches the limit. Every header and digest is made anew from the page.

Files are written under a temporary name of the attempt and renamed when
complete, so that a task that runs twice leaves the same files. The manifest, a
Parquet table that Spark's committer publishes as a whole, names the files that
count; the reader opens only these. The ranges, the order and all bytes depend on
the pages and the settings alone.

Of the pages with equal payloads (of ``min_revisit`` bytes or more) the one with the
largest id is the ``response``; the others are ``revisit`` records that refer to it.
Of repeated rows of that id the first in order of url is the response.

NULL html is an empty payload, a NULL url gives the target ``urn:page``; pages
without an id sort first and carry no id. An empty table gives an empty manifest
and no rows. Extra columns are ignored. A record is held in memory whole, a file never.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custlens.llm.common import stage
from custlens.session import scratch_path

SHARD_BYTES = 64 << 20
FILE_BYTES = 32 << 20
MIN_REVISIT = 0
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
URI_SAFE = "!#$%&'()*+,/:;=?@[]-._~"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-records")

MANIFEST = "shard long, file string, records long, payload_bytes long, file_bytes long"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}:{copy}')}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member; the member's header holds no time."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, copy: int, revisit: bool, refers_to: int | None, date: str
) -> bytes:
    digest = digest32(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe=URI_SAFE) if url else "urn:page"),
        ("Content-Type", HTTP_TYPE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    return record(headers, block)


def info_record(name: str, date: str) -> bytes:
    block = f"format: {VERSION}\r\nisPartOf: {name}\r\n".encode()
    return record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"),
            ("WARC-Date", date),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
            ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
        ],
        block,
    )


class _File:
    """A file of a shard: written under a name of this attempt, then renamed."""

    def __init__(self, folder: str, shard: int, number: int, date: str) -> None:
        self.system, base = fs.FileSystem.from_uri(folder)
        self.name = f"part-{shard:06d}-{number:05d}.warc.gz"
        self.final, self.temporary = f"{base}/{self.name}", f"{base}/.{self.name}.{uuid.uuid4().hex}"
        self.shard, self.records, self.payload = shard, 0, 0
        self.stream = self.system.open_output_stream(self.temporary, compression=None)
        first = info_record(self.name, date)
        self.stream.write(first)
        self.size = len(first)

    def add(self, member: bytes, payload: int) -> None:
        self.stream.write(member)
        self.size += len(member)
        self.records += 1
        self.payload += payload

    def close(self) -> tuple:
        self.stream.close()
        self.system.move(self.temporary, self.final)
        return self.shard, self.name, self.records, self.payload, self.size


def _ranges(ids: DataFrame, shard_bytes: int) -> list:
    """The least id of each range but the first; one entry per ``shard_bytes`` of payload.

    Only these cuts come to the driver: their number is the payload's size over
    ``shard_bytes``.
    """
    part = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(
        ids.select("page_id", "size")
        .repartitionByRange("page_id")
        .withColumn("part", F.spark_partition_id())
        .withColumn("within", F.coalesce(F.sum("size").over(part), F.lit(0))),
        "warc-sizes",
    )
    totals = placed.groupBy("part").agg(F.sum("size").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    cuts = (
        placed.join(F.broadcast(before), "part")
        .where(F.col("page_id").isNotNull())
        .groupBy(F.floor((F.col("before") + F.col("within")) / F.lit(shard_bytes)).alias("shard"))
        .agg(F.min("page_id").alias("cut"))
        .orderBy("shard")
        .collect()
    )
    return [c["cut"] for c in cuts][1:]


def write(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    min_revisit: int = MIN_REVISIT,
    date: str = DATE,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write ``pages`` below ``folder`` and return the manifest as it was committed."""
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html).alias("digest"),
    )
    ids = stage(keyed.select("page_id", "digest", F.octet_length("html").cast("long").alias("size")), "warc-ids")
    cuts = _ranges(ids, shard_bytes)
    shared = stage(
        ids.where(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("main"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "main", F.lit(True).alias("shared")),
        "warc-shared",
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = [0 if i is None else bisect.bisect_right(cuts, i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int32()), *batch.columns], names=["shard", *batch.schema.names]
            )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, number, last, copy, done = None, 0, None, 0, []
        for batch in batches:
            for shard, page_id, url, html, digest, main, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ and (open_.shard != shard or open_.size >= file_bytes):
                    number = number + 1 if open_.shard == shard else 0
                    done.append(open_.close())
                    open_ = None
                open_ = open_ or _File(folder, shard, number, date)
                copy = copy + 1 if last == (page_id, digest) else 0
                last = (page_id, digest)
                payload = html.encode("utf-8", "surrogatepass")
                revisit = bool(shared) and (page_id != main or copy > 0)
                open_.add(page_record(page_id, url, payload, copy, revisit, main, date), len(payload))
        if open_:
            done.append(open_.close())
        if done:
            names = ["shard", "file", "records", "payload_bytes", "file_bytes"]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names
            )

    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    routed = keyed.join(shared, "digest", "left").select("page_id", "url", "html", "digest", "main", "shared")
    manifest = (
        routed.mapInArrow(
            route, "shard int, page_id long, url string, html string, digest string, main long, shared boolean"
        )
        .repartitionById(len(cuts) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page_id", "digest", "url")
        .mapInArrow(archive, MANIFEST)
    )
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers (names in lower case) and blocks of an archive, one at a time."""
    while line := stream.readline():
        if line.strip() != VERSION.encode():
            raise ValueError(f"no record starts here: {line[:80]!r}")
        headers = {}
        while line := stream.readline().strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _page_row(headers: dict[str, str], block: bytes) -> tuple:
    if headers["warc-block-digest"] != f"sha1:{digest32(block)}":
        raise ValueError(f"block of {headers['warc-record-id']} doesn't match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response" and (digest != digest32(payload) or size != len(payload)):
        raise ValueError(f"payload of {headers['warc-record-id']} doesn't match its digest")
    own, other = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    return own and int(own), size, digest, headers["warc-type"], other and int(other)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), checked against all digests."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names
            )

        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = []
                with system.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as data:
                    for headers, block in records(data):
                        if headers["warc-type"] != "warcinfo":
                            found.append(_page_row(headers, block))
                        if len(found) >= 1000:
                            yield batch_of(found)
                            found = []
                if found:
                    yield batch_of(found)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")
    # A file is the unit of reading: one task for each, whatever the manifest's layout.
    n = max(1, files.count())
    spread = files.repartition(n, "file")
    return spread.mapInArrow(
        rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, **settings) -> DataFrame:
    """Write ``pages`` to a new folder in the shared one and read the archives back."""
    folder = scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    write(pages, folder, **settings)
    return read(pages.sparkSession, folder)
