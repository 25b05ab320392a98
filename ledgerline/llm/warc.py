"""WARC archives: one gzip member per record, written from a table of pages and
read back sequentially.

*Writing.* Of pages with equal payloads (the html in UTF-8, null as empty) of at
least ``REVISIT_BYTES`` bytes, the one with the smallest page_id is a response
and the others revisit it, without their payload; smaller payloads are all
responses. Only the digests of repeated payloads are gathered: a map-side
combined minimum per digest, broadcast up to ``BROADCAST_DIGESTS`` of them and
joined by a splittable shuffle beyond. Each task writes its pages to archives of
about ``ARCHIVE_BYTES`` in shared storage under names of its own; the manifest
of archives is a table that Spark commits, so files of lost or repeated task
attempts are never read.

*Reading.* One archive is read front to back: gzip member after gzip member with
incremental decompression, the header up to the empty line, then as many bytes
as Content-Length says, in portions. The digests of block and payload are
verified on the way. Memory is one portion, whatever the records' sizes (unless
payloads are asked for). Truncated or altered archives are errors.

Defined cases: empty and null payloads are responses of 0 bytes; a null page_id
is never smallest; rows that repeat a page_id and its payload are each what
that page is; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.storage import materialise
from ledgerline.session import scratch_path

REVISIT_BYTES = 100
BROADCAST_DIGESTS = 200_000
ARCHIVE_BYTES = 64 << 20
PORTION = 1 << 16
DATE = "1970-01-01T00:00:00Z"           # the table has no fetch times

_ID = "urn:ledgerline:page:"
_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    uri = uri.replace("s3a://", "s3://", 1)
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(uri: str) -> str:
    """``file:/x`` as ``file:///x``."""
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _record_id(page_id) -> str:
    return f"<{_ID}{'none' if page_id is None else quote(str(page_id), safe='')}>"


def _page_id(record_id: str) -> str | None:
    name = record_id.strip("<>")[len(_ID):]
    return None if name == "none" else unquote(name)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, not yet compressed. ``refers_to``: the record id of the
    response that a revisit refers to."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + b"\r\n\r\n")
    if refers_to is None:
        block += payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)),
              ("WARC-Date", DATE), ("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~") if url else None),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("WARC-Refers-To", refers_to), ("WARC-Profile", _PROFILE if refers_to else None),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class _Members:
    """The bytes of one gzip member after the other."""

    def __init__(self, stream):
        self._stream, self._rest, self._inflate = stream, b"", None

    def open(self) -> bool:
        """Start the next member; whether there is one."""
        self._rest = self._rest or self._stream.read(PORTION)
        if not self._rest:
            return False
        self._inflate = zlib.decompressobj(31)
        return True

    def read(self) -> bytes:
        """The next portion, empty at the member's end."""
        while not self._inflate.eof:
            data = self._inflate.decompress(self._rest, PORTION)
            self._rest = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
            if data:
                return data
            if not self._rest and not self._inflate.eof:
                self._rest = self._stream.read(PORTION)
                if not self._rest:
                    raise ValueError("the archive ends within a record")
        return b""


def _headers(data: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = data.decode("utf-8").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines if line)}


def _check(found, stated: str, what: str) -> None:
    if f"sha256:{found.hexdigest()}" != stated:
        raise ValueError(f"{what} does not match its digest")


def read_records(stream, with_payload: bool = False) -> Iterator[dict]:
    """The records of one archive, in order, verified."""
    members = _Members(stream)
    while members.open():
        pending = b""
        while b"\r\n\r\n" not in pending:
            more = members.read()
            if not more:
                raise ValueError("a record's header has no end")
            pending += more
        head, pending = pending.split(b"\r\n\r\n", 1)
        version, fields = _headers(head)
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        left = int(fields["content-length"])
        block_sha, payload_sha, http, payload, parts = hashlib.sha256(), hashlib.sha256(), None, 0, []
        unread = b""                    # of the block, before the HTTP header's end is seen
        while left:
            pending = pending or members.read()
            if not pending:
                raise ValueError("a record is shorter than its Content-Length")
            data, pending = pending[:left], pending[left:]
            left -= len(data)
            block_sha.update(data)
            if http is None:
                unread += data
                if b"\r\n\r\n" not in unread:
                    continue
                head, data = unread.split(b"\r\n\r\n", 1)
                http = _headers(head)[1]
            payload_sha.update(data)
            payload += len(data)
            if with_payload:
                parts.append(data)
        while True:
            more = members.read()
            if not more:
                break
            pending += more
        if pending != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        _check(block_sha, fields["warc-block-digest"], "a block")
        revisit = fields["warc-type"] == "revisit"
        if not revisit:
            _check(payload_sha, fields["warc-payload-digest"], "a payload")
            if payload != int(http["content-length"]):
                raise ValueError("a payload's length is not the stated one")
        yield {"page_id": _page_id(fields["warc-record-id"]), "payload_bytes": int(http["content-length"]),
               "payload_digest": fields["warc-payload-digest"].split(":", 1)[1], "record_type": fields["warc-type"],
               "refers_to": _page_id(fields["warc-refers-to"]) if revisit else None,
               **({"payload": b"".join(parts)} if with_payload else {})}


def _write_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        out, name, records, size, made = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(name, compression=None)
                refers_to = _record_id(first[0]) if first and first[0] != page_id else None
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = deflate.compress(record(page_id, url, (html or "").encode(), digest, refers_to)) + deflate.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    made.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            made.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["archive", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) to archives
    under ``folder`` (a URI in shared storage that pyarrow's file systems
    reach); the manifest: archive, records, bytes."""
    spark = pages.sparkSession
    text = F.coalesce(F.col("html"), F.lit(""))
    tagged = pages.select("page_id", "url", text.alias("html"), F.sha2(text, 256).alias("digest"))
    order = F.struct(F.col("page_id").isNull().alias("unknown"), F.col("page_id").alias("id"))
    firsts = materialise(
        tagged.filter(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("digest", F.array(F.col("least.id")).alias("first")), "repeated-payloads")
    few = firsts.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    named = tagged.join(F.broadcast(firsts) if few else firsts, "digest", "left")
    folder = _uri(folder)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    return materialise(named.select("page_id", "url", "html", "digest", "first")
                       .mapInArrow(_write_batches(folder), "archive string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, page_id_type: T.DataType | None = None) -> DataFrame:
    """The records of a manifest's archives, an archive per task: page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    folder = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _file_system(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(archive, compression=None) as stream:
                    for row in read_records(stream):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    archives = max(1, manifest.count())
    kind = (page_id_type or T.LongType()).simpleString()
    return (manifest.select("archive").repartition(archives)
            .mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, "
                             "refers_to string")
            .withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder, pages.schema["page_id"].dataType)
