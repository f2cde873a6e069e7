"""WARC records as a chunked table.

An archive is a table of (segment, record_id, chunk_no, last, data, sha256): the data of a
record's chunks, in order, are the bytes of one WARC/1.1 record, and `sha256` is the digest of
its payload up to the end of the chunk.  A reader holds one chunk at a time and checks the
digest as it goes; `segment` tells records apart even if whole rows repeat.  Oversized
payloads are many short rows, never one long buffer.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .storage import shared_dir

CHUNK = 64 << 10
#: Payloads below this are stored again however often they repeat.
LEAST = 100
_COLUMNS = "segment bigint, record_id string, chunk_no int, last boolean, data binary, sha256 string"
_NAMES = ["segment", "record_id", "chunk_no", "last", "data", "sha256"]


def record_id(page_id: int | None, digest: str) -> str:
    """A record's identifier, from its page and payload; only rows that repeat both share one."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def header(kind: str, page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """The head of a record, its HTTP head included.  A URL is percent-encoded where a header needs it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"X-Refers-To-Page: {refers_to}"]
    lines += [f"X-Page-Id: {'' if page_id is None else page_id}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if kind == 'revisit' else size)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def payload_digests(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) by built-in functions.

    Pages with equal payloads of LEAST bytes or more are a group whose smallest page_id responds.
    The smallest id comes from a partial aggregation, so a hot payload is nobody's group.
    """
    html = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    x = pages.select("page_id", F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"))
    first = x.where(f"payload_bytes >= {LEAST} and page_id is not null").groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first")
    repeat = F.col("first").isNotNull() & (F.col("payload_bytes") >= LEAST) & (F.col("page_id") != F.col("first"))
    return x.join(first, "payload_digest", "left").select("page_id", "payload_bytes", "payload_digest", F.when(repeat, "revisit").otherwise("response").alias("record_type"), F.when(repeat, F.col("first")).alias("refers_to"))


def chunk_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The archive rows of pages(page_id, url, html), written in one pass after the digests.

    Only revisits are joined in, a page that is none of them is a response: pages that repeat no
    payload pass through the join unmatched.  A page_id that repeats with another payload is
    told apart by its digest.
    """
    meta = payload_digests(pages).where("record_type = 'revisit'").select("page_id", "payload_digest", "refers_to").distinct()
    html = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("payload_digest", F.sha2("html", 256))
    rows = rows.join(meta, ["page_id", "payload_digest"], "left").select("page_id", "url", "html", "payload_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        segment = TaskContext.get().partitionId() << 40
        for batch in batches:
            for page, url, html, digest, refers in zip(*(batch.column(i) for i in range(5)), strict=True):
                page, refers, body = page.as_py(), refers.as_py(), memoryview(html.as_buffer())
                kind = "response" if refers is None else "revisit"
                head = header(kind, page, url.as_py(), digest.as_py(), len(body), refers, date)
                left = body if kind == "response" else body[:0]
                state, rid = hashlib.sha256(), record_id(page, digest.as_py())
                ends = [*range(max(1, CHUNK - len(head)), len(left), CHUNK), len(left)]
                start, segment = 0, segment + 1
                for no, end in enumerate(ends):
                    piece = left[start:end]
                    state.update(piece)
                    last = no == len(ends) - 1
                    data = (head if no == 0 else b"") + bytes(piece) + (b"\r\n\r\n" if last else b"")
                    out.append((segment, rid, no, last, data, state.hexdigest()))
                    held, start = held + len(data), end
                    if held > 4 << 20:
                        yield _rows(out)
                        out, held = [], 0
        yield _rows(out)

    return rows.mapInArrow(run, _COLUMNS)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=_NAMES)


def write_archive(pages: DataFrame, path: str) -> int:
    """Writes the pages' records as a chunked record table; returns their number, counted as they are written."""
    seen = Observation()
    rows = chunk_records(pages).observe(seen, F.count(F.when(F.col("chunk_no") == 0, 1)).alias("records"))
    rows.write.option("compression", "zstd").parquet(path)
    return seen.get["records"]


def _head(data: bytes) -> tuple[dict[str, str], int]:
    """A record's named fields and where its payload begins."""
    end = data.index(b"\r\n\r\n") + 4
    fields = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:] if ": " in line)
    assert data.startswith(b"WARC/1.1\r\n"), "not a WARC record"
    return fields, data.index(b"\r\n\r\n", end) + 4


class _Reader:
    """Reads one record chunk by chunk."""

    def __init__(self, data: bytes):
        self.fields, at = _head(data)
        self.state, self.size, self.next, self.tail = hashlib.sha256(), 0, 0, b""
        self.http = int(re.search(rb"Content-Length: (\d+)", data[data.index(b"HTTP/1.1") : at])[1])

    def feed(self, no: int, last: bool, data: bytes, sha256: str) -> tuple | None:
        """The record's result row after its last chunk."""
        if no != self.next:
            raise ValueError(f"chunk {self.next} of {self.fields['WARC-Record-ID']} is missing")
        piece = data[_head(data)[1] if no == 0 else 0 : len(data) - 4 if last else len(data)]
        self.state.update(piece)
        self.size, self.next = self.size + len(piece), no + 1
        if self.state.hexdigest() != sha256:
            raise ValueError(f"chunk {no} of {self.fields['WARC-Record-ID']} is damaged")
        if not last:
            return None
        kind, digest = self.fields["WARC-Type"], self.fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response" and (self.state.hexdigest() != digest or self.size != self.http):
            raise ValueError(f"{self.fields['WARC-Record-ID']} is damaged")
        page, to = self.fields.get("X-Page-Id", ""), self.fields.get("X-Refers-To-Page")
        return int(page) if page else None, self.http, digest, kind, int(to) if to else None


def read_archive(archive: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record.

    Records of one chunk are read where they lie.  Only those of several chunks are brought
    together, and then sorted, so that a task holds one chunk of one record at a time.  A record
    whose first, last or any other chunk is missing is an error.
    """
    result = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, open_ = None, None

        def ended() -> None:
            if reader is not None:
                raise ValueError(f"chunk {reader.next} of {reader.fields['WARC-Record-ID']} is missing")

        for batch in batches:
            out = []
            for segment, rid, no, last, data, sha in zip(*(batch.column(i) for i in range(6)), strict=True):
                data = data.as_buffer().to_pybytes()
                if no.as_py() == 0:
                    ended()
                    reader, open_ = _Reader(data), segment.as_py()
                elif reader is None or segment.as_py() != open_:
                    ended()
                    raise ValueError(f"chunk 0 of {rid.as_py()} is missing")
                row = reader.feed(no.as_py(), last.as_py(), data, sha.as_py())
                if row:
                    out.append(row)
                    reader = None
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        ended()

    rows = archive.select(*_NAMES)
    single = F.col("last") & (F.col("chunk_no") == 0)
    long = rows.where(~single).repartition("segment").sortWithinPartitions("segment", "chunk_no")
    return rows.where(single).mapInArrow(run, result).unionByName(long.mapInArrow(run, result))


def warc_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a record per row of pages(page_id, url, html), reads the archive, returns its records.

    A null html is an empty payload and a null url is about:blank.  Payloads below LEAST bytes are
    all responses.  Other columns of pages are ignored.
    """
    path = path or shared_dir(pages.sparkSession) + "-warc"
    written = write_archive(pages, path)
    archive = pages.sparkSession.read.parquet(path)
    found = archive.where("chunk_no = 0").count()
    if found != written:
        raise ValueError(f"{written} records were written and {found} are in the archive")
    return read_archive(archive)
