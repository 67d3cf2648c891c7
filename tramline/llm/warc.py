"""Web archives: pages written as WARC records, one gzip member each, and read back sequentially.

Equal payloads are stored once: the page with the smallest id is a ``response``
and the others are ``revisit`` records that name it. The reader takes a file as
a stream, member by member; it keeps to the Content-Length of each record, and
checks the digest of the block and of the payload on the way, without holding
more than a piece of either.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import settle
from tramline.llm.files import Output, make_folder, open_stream
from tramline.session import shared_dir

#: Payloads below this size are always stored.
LEAST_BYTES = 100
#: Bytes after which a task begins the next file.
FILE_BYTES = 64 << 20
PIECE = 1 << 16
LEVEL = 6
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("2f0f6f0a-7b54-4b5e-9f0a-51d6c8a7e001")


def decided(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` per page; the payload is the html in UTF-8, null is empty.

    Of pages with equal payloads of at least ``LEAST_BYTES`` the one with the
    smallest id is the response; rows that repeat that id are responses too.
    Pages without an id are revisits of such a response, or responses if no
    page with that payload has an id.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_BYTES
    firsts = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")) \
        .filter("n > 1 and first is not null").select(F.col("digest").alias("_digest"), "first")
    # Payloads that are always stored need no partner; their key spreads them.
    key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.withColumn("_key", key).join(firsts, F.col("_key") == F.col("_digest"), "left") \
        .select("page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                F.when(again, F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, record_type: str, refers_to: int | None,
           date: str) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if record_type == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_PLAIN)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    if record_type == "revisit":
        lines += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n") + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


_PLAIN = "".join(map(chr, range(33, 127)))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes one archive or more per task, and a manifest table ``url, n_records`` of those that counted; returns it."""
    make_folder(folder)
    most = FILE_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")]
            for row in zip(*columns):
                if out and out.size > most:
                    yield _closed(out, n)
                    out, n = None, 0
                out = out or Output(folder, "pages", ".warc.gz")
                out.write(record(*(v.as_py() for v in row), date))
                n += 1
        if out:
            yield _closed(out, n)

    decided(pages).mapInArrow(write, "url string, n_records long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def _closed(out: Output, n: int) -> pa.RecordBatch:
    out.close()
    return pa.RecordBatch.from_arrays([pa.array([out.url]), pa.array([n], pa.int64())], ["url", "n_records"])


class BrokenArchive(ValueError):
    """A record that is cut short, has no frame, or whose digest is another."""


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None


class _Member:
    """The bytes of one gzip member after the other, decompressed as asked for."""

    def __init__(self, stream: BinaryIO):
        self._stream, self._raw, self._have = stream, b"", b""
        self._unpack: zlib._Decompress | None = None

    def begin(self) -> bool:
        if not self._raw:
            self._raw = self._stream.read(PIECE)
        self._unpack, self._have = zlib.decompressobj(31), b""
        return bool(self._raw)

    def more(self) -> bytes:
        """The next piece, empty at the end of the member."""
        while not self._unpack.eof:
            if not self._raw and not self._unpack.unconsumed_tail:
                self._raw = self._stream.read(PIECE)
                if not self._raw:
                    raise BrokenArchive("the archive ends within a record")
            feed, self._raw = self._unpack.unconsumed_tail or self._raw, b"" if not self._unpack.unconsumed_tail else self._raw
            try:
                out = self._unpack.decompress(feed, PIECE)
            except zlib.error as e:
                raise BrokenArchive(str(e)) from e
            if self._unpack.eof:
                self._raw = self._unpack.unused_data + self._raw
            if out:
                return out
        return b""

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while (at := self._have.find(mark)) < 0:
            piece = self.more()
            if not piece or len(self._have) > most:
                raise BrokenArchive("headers without an end")
            self._have += piece
        out, self._have = self._have[:at], self._have[at + len(mark):]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            self._have = self._have or self.more()
            if not self._have:
                raise BrokenArchive("a block shorter than its Content-Length")
            piece, self._have = self._have[:n], self._have[n:]
            n -= len(piece)
            yield piece

    def rest(self) -> bytes:
        out = self._have
        while (piece := self.more()) and len(out) < 16:
            out += piece
        return out


def _headers(text: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = text.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_records(stream: BinaryIO, with_payload: bool = False) -> Iterator[Record]:
    """The records of one archive, their lengths and digests checked."""
    member = _Member(stream)
    while member.begin():
        version, headers = _headers(member.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise BrokenArchive(f"no record: {version[:20]!r}")
        out, block, digest = Record(headers), hashlib.sha256(), hashlib.sha256()
        head, kept, n = b"", [], 0
        for piece in member.pieces(int(headers["content-length"])):
            block.update(piece)
            if not out.http:
                head += piece
                if (at := head.find(b"\r\n\r\n")) < 0:
                    continue
                out.http, piece = _headers(head[:at])[1], head[at + 4:]
            digest.update(piece)
            n += len(piece)
            if with_payload:
                kept.append(piece)
        if member.rest() != b"\r\n\r\n":
            raise BrokenArchive("no end of the record after its block")
        if headers.get("warc-block-digest") != f"sha256:{block.hexdigest()}":
            raise BrokenArchive("the block's digest is another")
        promised = headers["warc-payload-digest"].removeprefix("sha256:")
        length = int(out.http.get("content-length", n))
        if headers["warc-type"] == "response" and (promised != digest.hexdigest() or length != n):
            raise BrokenArchive("the payload's digest or length is another")
        out.payload_bytes, out.payload_digest = length, promised
        out.payload = b"".join(kept) if with_payload and headers["warc-type"] == "response" else None
        yield out


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` per record of a folder's archives, and its payload if asked for.

    A revisit's length and digest are those of the payload it stands for.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        schema, names, kinds = f"{schema}, payload binary", [*names, "payload"], [*kinds, pa.binary()]

    def number(x: str | None) -> int | None:
        return None if x is None else int(x)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column("url").to_pylist():
                rows, held = [], 0
                with open_stream(url) as stream:
                    for r in read_records(stream, with_payload):
                        h = r.headers
                        rows.append((number(h.get("x-page-id")), h.get("warc-target-uri"), r.payload_bytes, r.payload_digest,
                                     h["warc-type"], number(h.get("x-refers-to-page-id")), r.payload)[:len(names)])
                        held += len(r.payload or b"")
                        if len(rows) == 1000 or held > 1 << 22:
                            yield _rows(rows, names, kinds)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows, names, kinds)

    files = settle(spark.read.parquet(f"{folder}/manifest").select("url"), "files")
    return files.repartition(max(1, files.count()), "url").mapInArrow(read, schema)


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def archive_round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Writes ``pages`` to a new shared folder and reads the archives back."""
    folder = shared_dir(pages.sparkSession, "archives")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, with_payload)
