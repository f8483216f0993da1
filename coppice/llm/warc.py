"""WARC archives: a writer with revisit records and a splittable reader.

Writer: each archive is one row, a string of gzip members of one record each, and Spark's text writer puts one row in
a file. Its commit protocol makes the files whole even if executors are lost, in any store that Spark can write. What
the writer puts after a row, else a line end, is an empty gzip member, so that a file is nothing but members.

Reader: the archives are cut into byte ranges of ``split_bytes``, one task row each. A task looks in its range for the
gzip magic, takes a candidate for a member only if it decodes to a WARC record header, and owns the records that start
inside its range, reading past the range's end to finish the last. So each record is read once, wherever the cuts lie.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks as C
from .components import joined_by
from .shared import numbered, stored

MAGIC = b"\x1f\x8b\x08"


#: A gzip member of nothing, with which a file ends.
EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(kind: str, record: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member: an HTTP response with the payload, or a revisit with its headers alone.

    ``record`` is the record's id; X-Page-ID and X-Refers-To-Page-ID are extension fields with the keys.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record}>", f"WARC-Date: {date}", f"WARC-Target-URI: {' '.join(url.split())}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + z.flush()


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = 16 << 20, least: int = 100) -> None:
    """Archives of all rows of ``pages`` in the folder ``path``.

    Null payloads are empty. Of rows with equal payloads of at least ``least`` bytes, that with the smallest key is a
    response and the others revisit it; smaller payloads are always responses. Repeated rows are records of their own:
    rows that share the smallest key of a payload are all responses, so are rows with a null key whose payload no other
    key has; a null key revisits those that have one. Extra columns are not read; an empty table gives no archive.
    """
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    # The join's small side has keys and digests of payloads that occur more than once; if it is too large to be sent to
    # all tasks, records are dealt by digest, and a payload that many pages share can be split.
    rows = numbered(pages, html).select(F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), "text")
    rows = rows.withColumn("digest", F.sha2("text", 256))
    shared = rows.where(F.octet_length("text") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    rows = joined_by(rows, shared, "digest", "left").select("page_id", "url", "text", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done, place = [], 0, 0, TaskContext.get().partitionId()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

        for batch in batches:
            for part, texts in C.slices(batch, "text", 4 << 20):
                for k, u, t, d, r in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), texts.to_pylist(), part.column("digest").to_pylist(), part.column("refers_to").to_pylist(), strict=True):
                    done += 1
                    record = uuid.uuid5(uuid.NAMESPACE_URL, f"{path}/{place}/{done}")
                    held.append(member("response" if r is None else "revisit", record, k, u, t.encode(), d, r, date))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    rows.mapInArrow(archive, "archive binary").select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).text(path)


class Bytes:
    """A file read at any place, through Python for local paths, else through the file systems of pyarrow."""

    def __init__(self, uri: str) -> None:
        if uri.startswith("file:"):
            import re
            from urllib.parse import unquote

            self.file = open(unquote(re.sub("^file:/*", "/", uri)), "rb")  # noqa: SIM115
        else:
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(uri)
            self.file = system.open_input_file(path)

    def at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def close(self) -> None:
        self.file.close()


def headers(block: bytes) -> tuple[dict[str, str], int] | None:
    """A record's headers, lower-case, and where its block begins; None if ``block`` does not begin with a whole WARC header."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"WARC/1.") or end < 0:
        return None
    pairs = [line.partition(":") for line in block[:end].decode("utf-8", "replace").split("\r\n")[1:]]
    found = {a.strip().lower(): b.strip() for a, _, b in pairs}
    return (found, end + 4) if found.get("content-length", "").isdigit() and "warc-type" in found else None


def inflate(source: Bytes, at: int, data: bytes, step: int = 1 << 20) -> tuple[bytes, int] | None:
    """The member that begins at ``at``, where ``data`` was read, and its length; None if no WARC record begins there."""
    z, out, fed, checked = zlib.decompressobj(31), [], 0, False
    try:
        while not z.eof:
            if not data and not (data := source.at(at + fed, step)):
                return None
            out.append(z.decompress(data))
            fed, data = fed + len(data), b""
            if not checked and (z.eof or sum(map(len, out)) >= 1 << 16):
                checked = True
                if headers(b"".join(out)) is None:
                    return None
    except zlib.error:
        return None
    return b"".join(out), fed - len(z.unused_data)


def records(source: Bytes, start: int, end: int, step: int = 1 << 20) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of the records that start in [start, end)."""
    at = start
    window, base = b"", start
    while at < end:
        if not (base <= at < base + len(window)):
            window, base = source.at(at, step), at
            if not window:
                return
        k = window.find(MAGIC, at - base)
        if k < 0:  # the magic may lie across two windows
            at = max(at + 1, base + len(window) - 2)
            if len(window) < step:
                return
            window = b""
            continue
        at = base + k
        if at >= end:
            return
        found = inflate(source, at, window[k:])
        if found is None:
            at += 1
            continue
        head, body = headers(found[0])
        yield at, head, found[0][body : body + int(head["content-length"])]
        at += found[1]


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers of a block."""
    return block.partition(b"\r\n\r\n")[2]


def read(spark: SparkSession, path: str, split_bytes: int = 4 << 20) -> DataFrame:
    """page_id, url, record_type, refers_to, digest (of the header), payload_bytes and payload_sha256 of the payload read."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("length")).alias("end"))
    ranges = ranges.repartition(F.col("path"), F.col("start"))

    def number(head: dict[str, str], field: str) -> int | None:
        return int(head[field]) if head.get(field) else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", "payload_sha256"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for p, a, b in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                source, rows = Bytes(p), []
                for _, head, block in records(source, a, b):
                    body = payload_of(block)
                    rows.append((number(head, "x-page-id"), head.get("warc-target-uri", ""), head["warc-type"], number(head, "x-refers-to-page-id"), head["warc-payload-digest"].partition(":")[2], len(body), hashlib.sha256(body).hexdigest()))
                source.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return ranges.mapInArrow(scan, "page_id long, url string, record_type string, refers_to long, digest string, payload_bytes long, payload_sha256 string")


def resolved(found: DataFrame) -> DataFrame:
    """Each record with the full payload's size and digest; a revisit has those of the responses with its digest, whose payloads are equal."""
    responses = found.where("record_type = 'response'")
    full = responses.groupBy("digest").agg(F.min("payload_bytes").alias("full_bytes"), F.min("payload_sha256").alias("full_sha256"))
    own = responses.select("page_id", "payload_bytes", F.col("payload_sha256").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    # One payload may have most of the revisits; both sides are dealt anew, so that these can be split.
    again = joined_by(found.where("record_type = 'revisit'"), full, "digest", "left")
    return own.unionByName(again.select("page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_sha256").alias("payload_digest"), "record_type", "refers_to"))


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of archives written to ``path`` and read back."""
    write(pages, path)
    return resolved(stored(read(pages.sparkSession, path), "records"))
