"""WARC archives: a writer of one gzip member per record, and a sequential reader that checks what it reads.

The reader inflates a stream bit by bit with zlib, a member at a time; takes a record's block by its Content-Length;
and compares the block and the payload with the record's digests.  It reads archives of other writers too: records of
all kinds, without digests or with those of other algorithms, and HTTP bodies in chunks.  Whatever does not fit (a
member cut short, bytes behind the block, a wrong digest) raises WarcError.  It never holds more than one chunk of a record
unless the payload is asked for.

Equal payloads are written once: of the pages with one payload that with the largest page_id becomes a response, the
others are revisit records that refer to it and keep the HTTP header, so the length of the payload stays known.

Defined results: a null or empty html is an empty payload; rows with the page_id of the response are responses too; a
null page_id is written as such, read back as null and never referred to while another page has the payload; a null
url gives a record without a target; an empty table gives no archive; extra columns do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm import words as W
from cosecha.llm.work import folder, saved, small

ARCHIVE_BYTES = 16 << 20  # an archive is closed after so many compressed bytes
CHUNK = 1 << 16
REVISIT_BYTES = 0  # smaller payloads are never revisits
DATE = "2024-01-01T00:00:00Z"
LEADERS = 500_000  # digests of repeated payloads that may be broadcast
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that is not well formed, or whose digests do not fit."""


def digest(sha1: "hashlib._Hash") -> str:
    return base64.b32encode(sha1.digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response, or a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest(hashlib.sha1(payload))}"), ("WARC-Block-Digest", f"sha1:{digest(hashlib.sha1(block))}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


class _Member:
    """One gzip member of a stream, inflated as it is read."""

    def __init__(self, file: BinaryIO, rest: bytes):
        self.file, self.rest, self.inflate, self.out = file, rest, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.rest or self.file.read(CHUNK)
        if not data:
            raise WarcError("the archive ends inside a record")
        if not self.inflate.unconsumed_tail:
            self.rest = b""
        try:
            self.out += self.inflate.decompress(data, CHUNK)
        except zlib.error as e:
            raise WarcError(f"no gzip member: {e}") from e
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
        return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        """All up to and with ``mark``."""
        at = -1
        while (at := self.out.find(mark)) < 0:
            if len(self.out) > most or not self._more():
                raise WarcError("a header without end")
        head, self.out = self.out[: at + len(mark)], self.out[at + len(mark) :]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in parts."""
        while n:
            if not self.out and not self._more():
                raise WarcError("the record is shorter than its Content-Length")
            part, self.out = self.out[:n], self.out[n:]
            n -= len(part)
            if part:
                yield part

    def close(self) -> bytes:
        """Checks the record's end; what was read beyond the member."""
        if b"".join(self.take(4)) != b"\r\n\r\n":
            raise WarcError("the record does not end where its Content-Length says")
        while self._more():
            pass
        if self.out:
            raise WarcError("a member holds more than one record")
        return self.rest


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a header by lower-case name; lines that start with a blank go on from the one before."""
    out: dict[str, str] = {}
    last = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class _Digests:
    """Digests of a stream by each algorithm that is asked for."""

    def __init__(self, *told: str | None):
        names = {"sha1", *(t.partition(":")[0].lower() for t in told if t)}
        self.by_name = {n: hashlib.new(n) for n in names & set(hashlib.algorithms_guaranteed) if not n.startswith("shake")}
        self.size = 0

    def update(self, part: bytes) -> None:
        self.size += len(part)
        for d in self.by_name.values():
            d.update(part)

    def fits(self, told: str | None) -> bool:
        """Whether this is the digest that was told, in base 32 or hexadecimal; one of an unknown kind is taken as told."""
        name, _, value = (told or "").partition(":")
        d = self.by_name.get(name.lower())
        return not told or d is None or value.strip().upper() in (digest(d), digest(d).rstrip("="), d.hexdigest().upper())


class _Unchunked:
    """The body inside an HTTP body that is sent in chunks, as its parts come in."""

    def __init__(self):
        self.held, self.left, self.done = b"", 0, False

    def feed(self, part: bytes) -> bytes:
        self.held += part
        out = []
        while self.held and not self.done:
            if self.left > 2:
                data = self.held[: self.left - 2]
                out.append(data)
                self.held, self.left = self.held[len(data) :], self.left - len(data)
            elif self.left:  # the line end behind a chunk
                n = min(self.left, len(self.held))
                self.held, self.left = self.held[n:], self.left - n
            else:
                line, end, rest = self.held.partition(b"\r\n")
                if not end:
                    if len(line) > 1 << 16:
                        raise WarcError("a chunk without a size")
                    break
                try:
                    size = int(line.split(b";")[0], 16)
                except ValueError as e:
                    raise WarcError("a chunk without a size") from e
                self.held, self.left, self.done = rest, size + 2 if size else 0, not size
        return b"".join(out)


def _page(urn: str | None) -> int | None:
    """The number in an id that the writer gave; ids of other archives have none."""
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.removeprefix("-").isascii() and number.removeprefix("-").isdigit() else None


def read_records(file: BinaryIO, with_payload: bool = False) -> Iterator[dict]:
    """The records of an archive of whatever kinds, one after the other; ``payload`` is None unless asked for.

    An HTTP message's payload is its body, without chunks if it is sent in chunks; any other record's is its block.
    A record without a digest, or with one of an unknown kind, is taken as it is.
    """
    rest = b""
    while rest := rest or file.read(CHUNK):
        member = _Member(file, rest)
        head = member.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise WarcError("no WARC record")
        fields = _fields(head)
        name, kind = fields.get("warc-record-id", "a record without id"), fields.get("warc-type", "").lower()
        length = fields.get("content-length", "")
        if not length.isdigit():
            raise WarcError(f"no Content-Length in {name}")
        of_block, of_payload = fields.get("warc-block-digest"), fields.get("warc-payload-digest")
        block, raw, body = _Digests(of_block), _Digests(of_payload), _Digests(of_payload)
        is_http = fields.get("content-type", "").lower().startswith("application/http") and kind in ("response", "request", "revisit")
        header, http, chunks, parts = b"", None if is_http else {}, None, []
        for part in member.take(int(length)):
            block.update(part)
            if http is None:
                header += part
                at = header.find(b"\r\n\r\n")
                if at < 0:
                    if len(header) > 1 << 20:
                        raise WarcError(f"an HTTP header without end in {name}")
                    continue
                part, http = header[at + 4 :], _fields(header[: at + 4])
                chunks = _Unchunked() if "chunked" in http.get("transfer-encoding", "").lower() else None
            raw.update(part)
            part = chunks.feed(part) if chunks else part
            body.update(part)
            if with_payload:
                parts.append(part)
        rest = member.close()
        if is_http and http is None:
            http = _fields(header)
        if not block.fits(of_block):
            raise WarcError(f"wrong block digest in {name}")
        told = http.get("content-length", "")
        if kind != "revisit" and "warc-truncated" not in fields:
            if not (body.fits(of_payload) or raw.fits(of_payload)):
                raise WarcError(f"wrong payload in {name}")
            if not of_payload and told.isdigit() and not chunks and int(told) != body.size and kind == "response":
                raise WarcError(f"wrong payload in {name}")
        sha1 = of_payload.partition(":")[2] if of_payload and of_payload.lower().startswith("sha1:") else None
        yield {
            "page_id": _page(fields.get("warc-record-id")),
            "url": fields.get("warc-target-uri"),
            "payload_bytes": int(told) if kind == "revisit" and told.isdigit() else body.size,
            "payload_digest": sha1 if sha1 or kind == "revisit" else digest(body.by_name["sha1"]),
            "record_type": kind,
            "refers_to": _page(fields.get("warc-refers-to")),
            "payload": b"".join(parts) if with_payload and kind != "revisit" else None,
            "record_id": fields.get("warc-record-id"),
            "date": fields.get("warc-date"),
        }


def _writer(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, number = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        out, uri, size, count = None, "", 0, 0

        def close() -> pa.RecordBatch:
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pydict({"uri": [uri], "records": [count]})

        for batch in batches:
            for piece in W.pieces(batch, "html"):
                for row in piece.to_pylist():
                    if out is None:
                        uri, size, count = f"{base}/part-{part:06d}-{number:04d}-{attempt}.warc.gz", 0, 0
                        fs, path = pa.fs.FileSystem.from_uri(uri)
                        fs.create_dir(os.path.dirname(path), recursive=True)
                        out = fs.open_output_stream(path, compression=None)
                        number += 1
                    data = record(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"])
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= ARCHIVE_BYTES:
                        yield close()
        if out is not None:
            yield close()

    return run


SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, record_id string, date string"
_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    + [("record_id", pa.string()), ("date", pa.string())]
)


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                fs, path = pa.fs.FileSystem.from_uri(uri)
                with fs.open_input_stream(path, compression=None) as file:
                    held, size = [], 0
                    for row in read_records(file, with_payload):
                        held.append(row)
                        size += len(row["payload"] or b"")
                        if len(held) >= 2000 or size > 1 << 23:
                            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    return run


def write_archives(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives in the shared folder; returns their list (uri, records).

    A repeated task writes archives of its own; the list has those of the task that succeeded.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    body = F.encode("html", "UTF-8")
    own = own.withColumn("key", F.when(F.octet_length("html") >= revisit_bytes, F.sha1(body)))
    leaders = own.where("key is not null").groupBy("key").agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    leaders = saved(leaders.select("key", "leader"), "warc-leaders")
    told = own.join(small(leaders, LEADERS), "key", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("leader")), F.col("leader"))
    told = told.select("page_id", "url", "html", refers.alias("refers_to"))
    return saved(told.mapInArrow(_writer(folder(pages.sparkSession, "warc")), "uri string, records long"), "warc-files")


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives in ``files`` (uri); a task reads whole archives from front to back."""
    tasks = max(1, min(files.count(), 10_000))
    return files.select("uri").repartition(tasks, "uri").mapInArrow(_reader(with_payload), SCHEMA)


def op1(spark, sf_dir: str) -> DataFrame:
    """One row per page, read from the archives."""
    files = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(files, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Five hexadecimal digits make four of base 32.
OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT hex, max(page_id) AS leader FROM p GROUP BY 1)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
                       FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = leader THEN NULL ELSE leader END AS refers_to
FROM p JOIN m USING (hex)
"""
