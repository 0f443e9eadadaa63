"""WARC archives as a chunked record table.

A record's bytes (header, payload, two line ends) are cut into rows of at most
``CHUNK`` bytes: (record, chunk number, number of chunks, bytes, running SHA-1
of the payload so far). Rows in order are a WARC 1.1 file. A record of one
chunk is read where it lies; the chunks of larger ones are brought together and
streamed in order, so neither side holds more than a chunk beside the page itself.

Equal payloads of ``LEAST_BYTES`` and more are stored once: the largest page id
is the response, the others are revisits of it.

Edge cases: NULL html is an empty payload; a page without an id can be a
response, but a revisit only of a page with one; pages equal in id and payload
are all responses; line breaks in a URL are percent-encoded and a NULL URL is left
out; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import stored
from tidemark.session import scratch_path

CHUNK = 64 << 10
LEAST_BYTES = 1000
END = b"\r\n\r\n"
ARCHIVE = "record string, chunk int, chunks int, data binary, running string"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame) -> DataFrame:
    """Pages with ``refers_to``: the page whose payload a revisit repeats, or NULL.

    Only ids and digests are grouped. The revisits among them are written first: if they
    are few enough for Spark to broadcast, no payload moves; else payloads move once, by page id.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("html"))
    own = own.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    large = own.filter(F.octet_length("html") >= LEAST_BYTES).select("page_id", "sha1")
    copies = large.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    targets = large.join(copies.select("sha1", "refers_to"), "sha1").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    a, b = own.alias("a"), stored(targets, "revisits").alias("b")
    same = F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.sha1") == F.col("b.sha1"))
    return a.join(b, same, "left").select("a.page_id", "a.url", "a.html", "b.refers_to")


def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _header(page_id, url, size: int, digest: bytes, refers_to, date: str) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode())
    lines.append(f"X-Payload-Length: {size}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if refers_to is not None else size}"]
    return "\r\n".join(lines).encode() + END


def _pieces(header: bytes, payload: memoryview, size: int):
    """The record in chunks, with the payload bytes that each chunk ends at."""
    total = len(header) + len(payload) + len(END)
    for lo in range(0, total, size):
        hi = min(lo + size, total)
        a, b = max(lo - len(header), 0), max(min(hi - len(header), len(payload)), 0)
        tail = END[max(lo - len(header) - len(payload), 0):max(hi - len(header) - len(payload), 0)]
        yield header[lo:hi], payload[a:b], tail


def _write(date: str, size: int):
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, held = [], 0
            urls, targets = batch.column("url").to_pylist(), batch.column("refers_to").to_pylist()
            for page_id, url, html, refers_to in zip(batch.column("page_id").to_pylist(), urls, batch.column("html"), targets):
                payload = memoryview(html.as_buffer())
                digest = hashlib.sha1(payload).digest()
                header = _header(page_id, url, len(payload), digest, refers_to, date)
                body = payload if refers_to is None else payload[:0]
                name, number = f"{task}-{number}", number + 1
                running = hashlib.sha1()
                chunks = -(-(len(header) + len(body) + len(END)) // size)
                for k, (head, part, tail) in enumerate(_pieces(header, body, size)):
                    running.update(part)
                    rows.append((name, k, chunks, b"".join((head, part, tail)), running.hexdigest()))
                    held += len(rows[-1][3])
                    if held > 4 << 20:
                        yield _archive_batch(rows)
                        rows, held = [], 0
            yield _archive_batch(rows)

    return run


def _archive_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["record", "chunk", "chunks", "data", "running"])


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", chunk: int = CHUNK) -> None:
    plan_records(pages).mapInArrow(_write(date, chunk), ARCHIVE).write.parquet(path)


class _Reader:
    """One record, chunk by chunk."""

    def __init__(self, record: str):
        self.record, self.next = record, 0
        self.head, self.fields = b"", None
        self.sha1, self.size, self.rest = hashlib.sha1(), 0, 0

    def _body(self, data) -> None:
        part = data[:self.rest]
        self.sha1.update(part)
        self.size += len(part)
        self.rest -= len(part)

    def feed(self, chunk: int, data: memoryview, running: str) -> None:
        if chunk != self.next:
            raise ValueError(f"record {self.record}: chunk {self.next} is missing")
        self.next += 1
        if self.fields is None:
            self.head += bytes(data)
            cut = self.head.find(END)
            if cut >= 0:
                lines = self.head[:cut].decode().split("\r\n")
                self.fields = dict(line.split(": ", 1) for line in lines[1:])
                self.rest = int(self.fields["Content-Length"])
                self._body(self.head[cut + len(END):])
                self.head = b""
        else:
            self._body(data)
        if self.sha1.hexdigest() != running:
            raise ValueError(f"record {self.record}: chunk {chunk} is damaged")

    def row(self) -> tuple:
        f = self.fields
        if f is None or self.rest:
            raise ValueError(f"record {self.record} is cut short")
        digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        kind = f["WARC-Type"]
        if kind == "response" and digest != self.sha1.hexdigest():
            raise ValueError(f"record {self.record}: the payload does not have its digest")
        number = lambda uri: int(uri[10:-1]) if uri[10:-1] else None
        refers = number(f["WARC-Refers-To"]) if kind == "revisit" else None
        return number(f["WARC-Record-ID"]), int(f["X-Payload-Length"]) if kind == "revisit" else self.size, digest, kind, refers


def _read(batches):
    reader = None
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("record", "chunk", "chunks", "running"))
        for record, chunk, chunks, running, data in zip(*columns, batch.column("data")):
            if chunk == 0:
                reader = _Reader(record)
            if reader is None or reader.record != record:
                raise ValueError(f"record {record} has no beginning")
            reader.feed(chunk, memoryview(data.as_buffer()), running)
            if chunk == chunks - 1:
                rows.append(reader.row())
                reader = None
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    if reader is not None:
        raise ValueError(f"record {reader.record} is cut short")


def read_archive(archive: DataFrame) -> DataFrame:
    """Records of an archive table, their digests checked."""
    names = ["record", "chunk", "chunks", "data", "running"]
    small = archive.filter("chunks = 1").select(*names)
    large = archive.filter("chunks > 1").select(*names).repartition("record").sortWithinPartitions("record", "chunk")
    return small.mapInArrow(_read, RESULT).unionByName(large.mapInArrow(_read, RESULT))


def round_trip(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path, chunk=chunk)
    return read_archive(spark.read.schema(ARCHIVE).parquet(path))
