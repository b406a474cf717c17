"""WARC archives: written from rows, normalised to one gzip member a record, read by offset.

A crawl often leaves an archive as one gzip stream, of which nothing can be read without
inflating all before it. `normalise` inflates each such file once, as a stream, writes
every record as a member of its own and next to it an index of offsets; `read_records`
then fetches any record by its offset.

Files go through pyarrow's filesystems, so a folder may be a local path or any URI they
know (file, s3, gs, hdfs). A file's name is fresh for each attempt of a task and counts
only once it is listed in a written table, so lost executors and repeated tasks leave at
most unused files. Memory is bounded by a record's header plus CHUNK bytes, in reading a
record by its payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import written
from tidelog.session import scratch_dir

CHUNK = 1 << 20
ARCHIVE_BYTES = 1 << 30
DATE = "1970-01-01T00:00:00Z"
# fixed values of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:{}>"

MANIFEST = "archive string, records long, bytes long"
INDEX = "archive string, offset long, length long, record_id string, record_type string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_references(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): what each page's record holds.

    Of pages with equal payloads of at least `min_bytes` bytes the largest page_id answers
    and the others refer to it. Rows that repeat that page_id all answer; a row without
    page_id refers to it, and answers where no row of its payload has one.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digests = pages.select("page_id", payload.alias("payload")).select(
        "page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size")
    )
    shared = digests.where(F.col("size") >= min_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("answer"), F.count("*").alias("n")
    )
    shared = written(spark, shared.where("n > 1 AND answer IS NOT NULL").select("sha1", "answer"), "answers")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    return rows.join(shared, "sha1", "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("answer")), F.col("answer")).alias("refers_to")
    )


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> Iterator[bytes]:
    """Header, block and end of one record. A revisit's block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = b"" if refers_to is not None else payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": RECORD_ID.format(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "WARC-Profile": None if refers_to is None else PROFILE,
        "WARC-Refers-To": None if refers_to is None else RECORD_ID.format(refers_to),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + len(body),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    yield f"WARC/1.1\r\n{lines}\r\n".encode() + http
    yield body
    yield b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, payload, refers_to) as whole-stream archives; returns their manifest.

    Each task writes its rows to archives of its own and begins another after
    `archive_bytes` inflated bytes. Nothing is written before the result is.
    """

    def write(batches):
        store, base = _at(folder)
        store.create_dir(base, recursive=True)
        out = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, gz, records, size = store.open_output_stream(posixpath.join(base, name), compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                for part in _record(*row):
                    out.write(gz.compress(part))
                    size += len(part)
                records += 1
                if size >= archive_bytes:
                    yield _closed(out, gz, folder, name, records, size)
                    out = None
        if out is not None:
            yield _closed(out, gz, folder, name, records, size)

    return rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, MANIFEST)


def _closed(out, gz, folder, name, records, size) -> pa.RecordBatch:
    out.write(gz.flush())
    out.close()
    return pa.RecordBatch.from_pylist([{"archive": posixpath.join(folder, name), "records": records, "bytes": size}])


class _Inflated:
    """Bytes of a gzip file of one or many members, inflated as they are asked for."""

    def __init__(self, stream, name: str):
        self.stream, self.name = stream, name
        self.gz = zlib.decompressobj(31)
        self.ready = bytearray()
        self.raw = b""

    def fill(self) -> bool:
        """One more chunk; False at the end of the file."""
        while True:
            if self.gz.eof:
                self.raw = self.gz.unused_data or self.stream.read(CHUNK)
                if not self.raw:
                    return False
                self.gz = zlib.decompressobj(31)
            elif not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise ValueError(f"{self.name} ends inside a gzip member")
            part = self.gz.decompress(self.raw, CHUNK)
            self.raw = self.gz.unconsumed_tail
            if part:
                self.ready += part
                return True

    def header(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        start = 0
        while True:
            at = self.ready.find(b"\r\n\r\n", start)
            if at >= 0:
                return self.take(at + 4)
            start = max(0, len(self.ready) - 3)
            if not self.fill():
                if self.ready.strip():
                    raise ValueError(f"{self.name} ends inside a record header")
                return None

    def take(self, n: int) -> bytes:
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def body(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.fill():
                raise ValueError(f"{self.name} ends inside a record")
            part = self.take(min(n, len(self.ready), CHUNK))
            n -= len(part)
            yield part


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def normalise(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Rewrite each archive of `manifest` with a member a record; returns the index.

    Next to a new archive lies `<archive>.index`, one JSON line a record with its offset
    and length; the returned rows are the same. Archives that have members already are
    read alike. A file that ends inside a member or record stops the job. An empty
    manifest gives an empty index.
    """

    def rewrite(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = _at(archive)
                name = archive.removesuffix(".warc.gz") + f"-{uuid.uuid4().hex}.warc.gz"
                target = _at(name)[1]
                rows = []
                with (
                    store.open_input_stream(path, compression=None) as source,
                    store.open_output_stream(target, compression=None) as out,
                    store.open_output_stream(f"{target}.index", compression=None) as index,
                ):
                    inflated = _Inflated(source, archive)
                    while (header := inflated.header()) is not None:
                        fields = _fields(header)
                        offset = out.tell()
                        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                        out.write(gz.compress(header))
                        for part in inflated.body(int(fields["content-length"]) + 4):
                            out.write(gz.compress(part))
                        out.write(gz.flush())
                        row = {
                            "archive": name,
                            "offset": offset,
                            "length": out.tell() - offset,
                            "record_id": fields["warc-record-id"],
                            "record_type": fields["warc-type"],
                        }
                        index.write(json.dumps(row).encode() + b"\n")
                        rows.append(row)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, _index_schema())
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _index_schema())

    # a task an archive: without the number, small manifests would end up in one task
    n = max(1, manifest.count())
    return written(spark, manifest.select("archive").repartition(n).mapInArrow(rewrite, INDEX), "warc-index")


def _index_schema() -> pa.Schema:
    return pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())]
    )


def _page(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:x-page:").removesuffix(">")
    return None if number in ("", "None") else int(number)


def read_records(index: DataFrame) -> DataFrame:
    """One row for each index row, read from its archive at its offset.

    page_id, payload_bytes and payload_digest (both of the full payload, a revisit's taken
    from its headers), record_type, refers_to (null unless a revisit) and url. A payload
    that does not fit its digest stops the job.
    """

    def read(batches):
        open_name, source = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["archive"] != open_name:
                    store, path = _at(row["archive"])
                    open_name, source = row["archive"], store.open_input_file(path)
                record = zlib.decompress(source.read_at(row["length"], row["offset"]), 31)
                header, _, rest = record.partition(b"\r\n\r\n")
                fields = _fields(header)
                block = rest[: int(fields["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                revisit = fields["warc-type"] == "revisit"
                if not revisit and digest_of(payload) != digest:
                    raise ValueError(f"{row['record_id']} in {row['archive']} does not fit its digest")
                out.append(
                    {
                        "page_id": _page(fields["warc-record-id"]),
                        "payload_bytes": int(_fields(http)["content-length"]) if revisit else len(payload),
                        "payload_digest": digest,
                        "record_type": fields["warc-type"],
                        "refers_to": _page(fields.get("warc-refers-to")),
                        "url": fields.get("warc-target-uri"),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, _record_schema())

    return index.mapInArrow(read, RECORDS)


def _record_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in RECORDS.split(", "))])


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as archives, normalise them and read them back.

    A null html is an empty payload, a null url leaves its header out. Every row gets a
    record, repeated rows too; other columns are not read; no pages give no rows.
    """
    folder = folder or scratch_dir(spark, "warc")
    manifest = written(spark, write_archives(with_references(spark, pages, min_bytes), folder), "warc-manifest")
    return read_records(normalise(spark, manifest))
