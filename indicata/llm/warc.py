"""WARC archives: a deduplicating writer and a salvaging reader.

Writer: one record per page.  Of the pages with equal payloads the one with the
largest id is written as ``response``; the others become ``revisit`` records
that refer to it and carry no payload.  Each record is a gzip member of its
own; a task rolls its files at ``file_bytes``.  Files are named by task attempt
and only those of committed attempts are listed in the returned manifest, so a
retried or speculative task cannot add records twice.

Reader: an archive is read as a stream, one record in memory at a time; a gzip member
may hold several records, up to a whole archive, and a header may have any length.  Every
record is checked: the member's checksum (gzip), version line, header fields,
``Content-Length`` against the bytes that follow, the closing empty lines, and
the block and payload digests.  After a failed check the reader searches on
for the next gzip member or version line whose record passes all checks, goes
on from there, and logs the bytes between as quarantined with the reason.  If
a record's frame is whole and only a digest differs, the place after the frame
is tried first.

Defined cases: a null payload is an empty one (empty payloads are equal to
each other); a null url is written without a target; pages with a null id are
written as responses and never referred to; rows repeating the largest id of a
payload are all responses; control characters in a url are percent-encoded; an
empty table gives no files and no records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm.skew import salted_join
from indicata.llm.store import small_batches, written
from indicata.session import scratch_path

FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
MEMBER_BYTES = 32 << 20  # of a gzip member's text in memory
# Fixed values of the WARC format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
GZIP_MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
BEGINNING = re.compile(rb"\x1f\x8b\x08|WARC/1\.")  # of a member or a version line
HEADER_END = re.compile(rb"\r\n\r\n|\r\nWARC/1\.|" + CONTROL.pattern)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    kind = "response" if refers_to is None else "revisit"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    if refers_to is None:
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID_PREFIX}{'null' if page_id is None else page_id}>"),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + END


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): ``refers_to`` is null for responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    first = written(rows.select("digest", "page_id").groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")), "payload-digests")
    joined = salted_join(rows, first, "digest", "n", "page_id")
    return joined.select("page_id", "url", "payload", F.when(
        F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, usable on executors."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", uri):
        return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace(":", "://", 1))
    return pafs.LocalFileSystem(), uri


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z",
               **columns: str) -> DataFrame:
    """Archives of ``pages`` under ``folder``; returns the manifest (path, records,
    bytes), written, so the archives exist when this returns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        done, out, size, count = [], None, 0, 0
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    name = f"{stem}-{len(done):04d}.warc.gz"
                    out, size, count = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                member = gzip_member(make_record(*row, date=date))
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((f"{folder}/{name}", count, size))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                names=["path", "records", "bytes"])

    small_batches(pages.sparkSession)
    rows = deduplicated(pages, **columns)
    return written(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


class Archive:
    """Random reads of one file through a window of ``READ_BYTES``."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.start, self.held = handle, size, 0, b""

    def read(self, pos: int, n: int) -> bytes:
        if not self.start <= pos <= pos + n <= self.start + len(self.held):
            self.handle.seek(pos)
            self.start, self.held = pos, self.handle.read(max(n, READ_BYTES))
        at = pos - self.start
        return self.held[at: at + n]

    def find(self, pattern: re.Pattern, pos: int) -> int:
        """The first place at or after ``pos`` where ``pattern`` (at most nine bytes) matches, else the end."""
        size = 4096  # most are near
        while pos < self.size:
            part = self.read(pos, min(size, self.size - pos))
            found = pattern.search(part)
            if found:
                return pos + found.start()
            if len(part) <= 8:
                break
            pos, size = pos + len(part) - 8, min(4 * size, READ_BYTES)
        return self.size

    def header(self, pos: int) -> bytes:
        """The bytes from ``pos`` to the first empty line, however far; raises Damaged if control
        bytes, another version line or the end of the file come first."""
        end = self.find(HEADER_END, pos)
        if self.read(end, len(END)) != END:
            raise Damaged("control bytes in the header" if CONTROL.match(self.read(end, 1)) else "header does not end")
        return self.read(pos, end + len(END) - pos)


class Damaged(Exception):
    """A failed check; ``end`` is where the frame ends, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def read_member(src: Archive, pos: int) -> tuple["Archive", int]:
    """The text of the gzip member at ``pos`` as an archive of its own, and the
    member's end.  Up to ``MEMBER_BYTES`` are held in memory; more of it lies in a file
    without a name that ends with the task."""
    z, at = zlib.decompressobj(31), pos
    out = tempfile.SpooledTemporaryFile(MEMBER_BYTES)
    while not z.eof:
        part = z.unconsumed_tail or src.read(at, min(1 << 16, src.size - at))
        if not part:
            raise Damaged("truncated gzip member")
        at += 0 if z.unconsumed_tail else len(part)
        try:
            out.write(z.decompress(part, READ_BYTES))
        except zlib.error:
            raise Damaged("bad gzip member") from None
    return Archive(out, out.tell()), at - len(z.unused_data)


def parse_head(data: bytes) -> tuple[dict[str, str], int]:
    """Header fields (lower-case names) and the place where the block starts."""
    if not VERSION_LINE.match(data):
        raise Damaged("no version line")
    stop = data.find(END)
    if stop < 0:
        raise Damaged("header does not end")
    if CONTROL.search(data, 0, stop):
        raise Damaged("control bytes in the header")
    fields: dict[str, str] = {}
    for line in data[:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    for name in ("warc-type", "warc-record-id", "content-length"):
        if name not in fields:
            raise Damaged(f"no {name}")
    if not fields["content-length"].isdigit():
        raise Damaged("bad content-length")
    return fields, stop + len(END)


def check_digest(fields: dict[str, str], name: str, data: bytes, end: int) -> None:
    declared = fields.get(name, "")
    if declared.lower().startswith("sha1:") and declared[5:].upper() != base32_sha1(data):
        raise Damaged(f"{name} differs", end)


def read_record(src: Archive, pos: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload and end of the plain record at ``pos``; raises Damaged."""
    if not VERSION_LINE.match(src.read(pos, 10)):
        raise Damaged("no version line")
    fields, at = parse_head(src.header(pos))
    length = int(fields["content-length"])
    end = pos + at + length + len(END)
    if end > src.size:
        raise Damaged("content-length past the end")
    block = src.read(pos + at, length)
    if src.read(end - len(END), len(END)) != END:
        raise Damaged("record does not close")
    check_digest(fields, "warc-block-digest", block, end)
    http, _, payload = block.partition(END) if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    if fields["warc-type"] == "revisit":
        m = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        fields["payload-bytes"] = m[1].decode() if m else ""
    else:
        check_digest(fields, "warc-payload-digest", payload, end)
        fields["payload-bytes"] = str(len(payload))
        fields["warc-payload-digest"] = "sha1:" + base32_sha1(payload)
    return fields, payload, end


def read_at(src: Archive, pos: int) -> tuple[Iterator[tuple], int]:
    """What ``salvage`` gives for the record, or the gzip member with records in it, at
    ``pos``, and its end; raises Damaged if no record passes the checks."""
    if src.read(pos, 3) != GZIP_MAGIC:
        fields, payload, end = read_record(src, pos)
        return iter([("record", pos, end, fields, payload)]), end
    member, end = read_member(src, pos)
    found, first = salvage(member), []
    for item in found:
        first.append(item)
        if item[0] == "record":
            break
    else:
        raise Damaged(first[0][3] if first else "empty gzip member", end)

    def inside() -> Iterator[tuple]:
        for kind, start, stop, *rest in itertools.chain(first, found):
            yield (kind, pos, end, *rest) if kind == "record" else (kind, pos, end, f"bytes {start} to {stop} of the member: {rest[0]}")

    return inside(), end


def salvage(src: Archive) -> Iterator[tuple]:
    """``("record", start, end, fields, payload)`` and ``("gap", start, end, reason)``
    in file order; together they cover the whole file.  What lies in one gzip member has the
    member's start and end."""
    pos = 0
    while pos < src.size:
        try:
            found, end = read_at(src, pos)
            yield from found
            pos = end
            continue
        except Damaged as bad:
            reason, start, resume = str(bad), pos, bad.end
        while True:  # the next place whose record passes all checks
            at = resume if resume is not None else src.find(BEGINNING, pos + 1)
            if resume is not None and at < src.size:
                try:
                    read_at(src, at)
                    break
                except Damaged:
                    resume = None
                    continue
            if at >= src.size:
                at = src.size
                break
            try:
                read_at(src, at)
                break
            except Damaged:
                pos = at
        yield "gap", start, at, reason
        pos = at


READ_SCHEMA = ("kind string, path string, start bigint, stop bigint, reason string, record_id string, record_type string, "
               "target_uri string, refers_to string, payload_bytes bigint, payload_digest string, payload binary")


def read_warc(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Rows of ``kind`` record (one per record that passes the checks) and gap (one
    per quarantined byte range) of the files in ``manifest.path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]])
                            for c in READ_SCHEMA.split(", ")])
        for b in batches:
            for path in b["path"].to_pylist():
                fs, name = filesystem(path)
                with fs.open_input_file(name) as handle:
                    rows, held = [], 0
                    for kind, start, stop, *rest in salvage(Archive(handle, handle.size())):
                        row = dict.fromkeys(schema.names)
                        row.update(kind=kind, path=path, start=start, stop=stop)
                        if kind == "gap":
                            row["reason"] = rest[0]
                        else:
                            f, payload = rest
                            row.update(record_id=f["warc-record-id"].strip("<>"), record_type=f["warc-type"],
                                       target_uri=f.get("warc-target-uri"),
                                       refers_to=f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None,
                                       payload_bytes=int(f["payload-bytes"]) if f["payload-bytes"] else None,
                                       payload_digest=f.get("warc-payload-digest", "")[5:].upper() or None)
                            if with_payload and f["warc-type"] != "revisit":
                                row["payload"] = payload
                        rows.append(row)
                        held += len(row["payload"] or b"") + 500
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    parts = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    # Dealt in turn, not by hash: archives are of one size (rolled), so tasks get equal shares and none is empty.
    return manifest.select("path").repartition(parts).mapInArrow(run, READ_SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """The page columns of the records read back from archives of ``write_warc``."""
    page = lambda c: F.substr(c, F.lit(len(ID_PREFIX) + 1)).try_cast("long")
    return records.where("kind = 'record'").select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page(F.col("refers_to")).alias("refers_to"))


def roundtrip(pages: DataFrame, **columns: str) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    spark = pages.sparkSession
    manifest = write_warc(pages, scratch_path(spark, "warc"), **columns)
    return page_records(read_warc(spark, manifest, with_payload=False))
