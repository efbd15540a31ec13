"""Zip archives of CSV files, read as a Spark job.

The archives are listed with the ``binaryFile`` source (content column not
selected, so no bytes are loaded by the scan).  One task per archive reads its
central directory and the header line of the selected members: the catalogue,
a small written table of places, sizes and headers.  From it the members are
dealt to tasks by their stored size, so that an archive of many members is
read by many tasks.  A task goes straight to its members' places and streams
them chunk by chunk (``mapInArrow``, lines split with Arrow compute): its memory
is one chunk of text.

A member's header is its first line that is not blank; members without one are
left out.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from indicata.functions.files import file_stem, open_input
from indicata.session import scratch_path
from indicata.sources.preamble import LINES_SCHEMA, check_header, header_tokens

MEMBER_LINES_SCHEMA = StructType([
    StructField("archive", StringType(), False),
    StructField("member", StringType(), False),
    StructField("line_no", LongType(), False),
    StructField("line", StringType(), True),
    StructField("layout", LongType(), False),  # names the member's header line
])
MAX_LAYOUTS = 1000

# Characters of member text decoded per batch (about 8 MB).
_CHUNK_CHARS = 8 * 1024 * 1024
# Line ends as Spark's text reader splits them.
_NEWLINE = re.compile(r"\r\n|\r|\n")


def layout_of(header: str) -> int:
    """A 64-bit name of a header line, the same on the driver and in tasks."""
    return int.from_bytes(hashlib.blake2b(header.encode(), digest_size=8).digest(), "little", signed=True)


def _line_arrays(text: io.TextIOBase) -> Iterator[pa.Array]:
    """Lines of a text stream as Arrow string arrays, one per chunk.

    Each chunk is split by one vectorised regex call; no Python object is
    made per line.  A line cut by a chunk boundary is carried over, and a
    trailing '\r' is held back in case the next chunk starts with '\n'.
    """
    carry = ""
    while True:
        chunk = text.read(_CHUNK_CHARS)
        if not chunk:
            break
        data = carry + chunk
        hold = ""
        if data.endswith("\r"):
            data, hold = data[:-1], "\r"
        parts = pc.split_pattern_regex(pa.array([data], pa.string()), pattern=_NEWLINE.pattern).flatten()
        carry = parts[len(parts) - 1].as_py() + hold
        if len(parts) > 1:
            yield parts.slice(0, len(parts) - 1)
    if carry:
        yield pa.array([carry[:-1] if carry.endswith("\r") else carry], pa.string())


# Local header of a member: 26 bytes before the lengths of its name and extra field.
_LOCAL_HEADER = "<26xHH"
_READ_BYTES = 1 << 20
# Stored bytes of members that one task reads, if they are smaller each.
UNIT_BYTES = 32 * 1024 * 1024


class _Member(io.RawIOBase):
    """The text of one member, from its place in the archive (no directory is read)."""

    def __init__(self, raw, name: str, place: int, stored: int, method: int, crc: int):
        raw.seek(place)
        size = struct.calcsize(_LOCAL_HEADER)
        raw.seek(place + size + sum(struct.unpack(_LOCAL_HEADER, raw.read(size))))
        self.raw, self.name, self.left, self.crc, self.sum = raw, name, stored, crc, 0
        self.inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        self.ready = b""

    def readable(self) -> bool:
        return True

    def _fill(self) -> None:
        while not self.ready and (self.left or self.inflate is not None and self.inflate.unconsumed_tail):
            data = self.inflate.unconsumed_tail if self.inflate is not None else b""
            if not data:
                data = self.raw.read(min(_READ_BYTES, self.left))
                if not data:
                    raise ValueError(f"{self.name}: the archive ends inside this member")
                self.left -= len(data)
            self.ready = data if self.inflate is None else self.inflate.decompress(data, 4 * _READ_BYTES)
        if not self.ready and self.inflate is not None:
            self.ready = self.inflate.flush()
            self.inflate = None
        self.sum = zlib.crc32(self.ready, self.sum)
        if not self.ready and self.sum != self.crc:
            raise ValueError(f"{self.name}: bad checksum")

    def readinto(self, buffer) -> int:
        if not self.ready:
            self._fill()
        n = min(len(buffer), len(self.ready))
        buffer[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


def _open_member(raw, name: str, place: int, stored: int, method: int, crc: int, encoding: str) -> io.TextIOWrapper:
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{name}: compression method {method} is not supported")
    member = io.BufferedReader(_Member(raw, name, place, stored, method, crc), _READ_BYTES)
    return io.TextIOWrapper(member, encoding=encoding, newline="")


def _head(text: io.TextIOBase, skip: int) -> str | None:
    """The line after ``skip`` lines, or with no lines to skip the first that is not blank."""
    for _ in range(skip):
        text.readline()
    while line := text.readline():
        if skip or line.strip():
            return line.rstrip("\r\n")
    return None


_CATALOGUE = pa.schema([("archive", pa.string()), ("stem", pa.string()), ("member", pa.string()), ("place", pa.int64()),
                        ("stored", pa.int64()), ("method", pa.int32()), ("crc", pa.int64()), ("header", pa.string())])
_CATALOGUE_DDL = ("archive string, stem string, member string, place bigint, stored bigint, method int, crc bigint, "
                  "header string")


def _read_directories(batches: Iterator[pa.RecordBatch], prefix: str | None, last_only: bool, skip: int,
                      encoding: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, stem in zip(batch["path"].to_pylist(), batch["stem"].to_pylist()):
            rows = []
            with open_input(path) as raw:
                with zipfile.ZipFile(raw) as zf:
                    found = [x for x in zf.infolist() if not x.is_dir()
                             and (prefix is None or x.filename.rsplit("/", 1)[-1].startswith(prefix))]
                    for x in found[-1:] if last_only else found:
                        name = f"{path}!{x.filename}"
                        if x.flag_bits & 1:
                            raise ValueError(f"{name}: encrypted members are not supported")
                        text = _open_member(raw, name, x.header_offset, x.compress_size, x.compress_type, x.CRC, encoding)
                        header = _head(text, skip)
                        if header is not None:
                            rows.append((path, stem, x.filename, x.header_offset, x.compress_size, x.compress_type, x.CRC, header))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_CATALOGUE.names, r)) for r in rows], schema=_CATALOGUE)


def _read_members(batches: Iterator[pa.RecordBatch], skip: int, encoding: str) -> Iterator[tuple[dict, int, pa.Array]]:
    """(catalogue row, number of the first line, lines) of the members' lines, from the header line on."""
    for batch in batches:
        for r in batch.to_pylist():
            with open_input(r["archive"]) as raw:
                text = _open_member(raw, f"{r['archive']}!{r['member']}", r["place"], r["stored"], r["method"], r["crc"], encoding)
                header, start = _head(text, skip), 1
                yield r, 0, pa.array([header], pa.string())
                for lines in _line_arrays(text):
                    yield r, start, lines
                    start += len(lines)


def _member_lines(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[pa.RecordBatch]:
    for r, start, lines in _read_members(batches, 0, encoding):
        n = len(lines)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(r["archive"], n), pa.repeat(r["member"], n), pa.array(np.arange(start, start + n, dtype=np.int64)),
             lines, pa.repeat(pa.scalar(layout_of(r["header"]), pa.int64()), n)], names=MEMBER_LINES_SCHEMA.names)


def _preamble_member_lines(batches: Iterator[pa.RecordBatch], skip: int, keep_empty: bool,
                           required: Sequence[str], encoding: str) -> Iterator[pa.RecordBatch]:
    """The lines after each member's header (line ``skip``), the header attached."""
    for r, start, lines in _read_members(batches, skip, encoding):
        if start == 0:
            tokens = header_tokens(r["header"], keep_empty)
            check_header(f"{r['archive']}!{r['member']}", tokens, required)
            header = pa.scalar(tokens, pa.list_(pa.string()))
            continue
        n = len(lines)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(f"{r['archive']}!{r['member']}", n), pa.repeat(r["stem"], n),
             pa.array(np.arange(start, start + n, dtype=np.int64) + skip), lines, pa.repeat(header, n)],
            names=["file", "stem", "offset", "line", "header_raw"])


def _listing(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, stem), dealt one archive per task as far as there are tasks."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    listing = listing.select("path", file_stem(F.element_at(F.split("path", "/"), -1)).alias("stem"))
    return listing.repartition(max(1, listing.count()), "path")


class ZipCatalogue:
    """The selected members of the archives under ``path``, with their headers.

    ``member_prefix`` keeps members whose file name starts with it (e.g.
    'API'); ``last_member`` keeps only the last member of each archive; the header is the line after
    ``skip`` lines (0: the first that is not blank).  Each archive's directory is read once.
    """

    def __init__(self, spark: SparkSession, path: str, member_prefix: str | None = None, last_member: bool = False,
                 skip: int = 0, encoding: str = "utf-8-sig", glob: str = "*.zip"):
        self.spark, self.path, self.skip, self.encoding = spark, path, skip, encoding
        target = scratch_path(spark, "zip-catalogue")
        _listing(spark, path, glob).mapInArrow(
            lambda it: _read_directories(it, member_prefix, last_member, skip, encoding), _CATALOGUE_DDL
        ).write.parquet(target)
        self.members = spark.read.schema(_CATALOGUE_DDL).parquet(target)

    def headers(self) -> list[str]:
        """The distinct header lines, at most ``MAX_LAYOUTS``."""
        return member_layouts(self.members.select(F.col("header").alias("line")))

    def columns(self) -> list[str]:
        """The names in any header: those of the first member by archive and name, then the others' new ones."""
        first = self.members.orderBy("archive", "place").select("header").first()
        if first is None:
            raise ValueError(f"no member with a header line under {self.path}")
        names = dict.fromkeys(header_columns(first.header))
        for h in self.headers():
            names |= dict.fromkeys(header_columns(h))
        return list(names)

    def stems(self) -> list[str]:
        return sorted(r.stem for r in self.members.select("stem").distinct().collect())

    def units(self) -> tuple[DataFrame, int]:
        """The members, dealt to tasks: neighbours in an archive are read by one task up to
        ``UNIT_BYTES`` of stored bytes, a larger one alone; and the number of units."""
        so_far = Window.partitionBy("archive").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        members = self.members.withColumn("unit", F.floor(F.coalesce(F.sum("stored").over(so_far), F.lit(0)) / UNIT_BYTES))
        n = members.select("archive", "unit").distinct().count()
        return members.repartition(max(1, n), "archive", "unit").sortWithinPartitions("archive", "place").drop("unit"), n

    def lines(self, spread: bool | None = None) -> DataFrame:
        """archive, member, line_no (0: the header), line, layout (names the header line).

        With fewer units than shuffle partitions the lines are spread over these, so that
        parsing a few large members is shared; ``spread`` settles it either way."""
        units, n = self.units()
        encoding = self.encoding
        found = units.mapInArrow(lambda it: _member_lines(it, encoding), schema=MEMBER_LINES_SCHEMA)
        return self._spread(found, n, spread, "archive", "member", "line_no")

    def preamble_lines(self, keep_empty: bool = False, required: Sequence[str] = (), spread: bool | None = None) -> DataFrame:
        """Lines of preamble-headed members in the shape ``preamble_records`` takes."""
        units, n = self.units()
        skip, needed, encoding = self.skip, tuple(required), self.encoding
        found = units.mapInArrow(lambda it: _preamble_member_lines(it, skip, keep_empty, needed, encoding), LINES_SCHEMA)
        return self._spread(found, n, spread, "file", "offset")

    def _spread(self, lines: DataFrame, units: int, spread: bool | None, *place: str) -> DataFrame:
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Hash on the line's position: deterministic on retry without the local
        # sort a round-robin repartition adds, and even across partitions.
        return lines.repartition(width, *place) if (units < width if spread is None else spread) else lines


def read_zip_members(spark: SparkSession, path: str, member_prefix: str | None = None,
                     last_member: bool = False, encoding: str = "utf-8-sig", glob: str = "*.zip") -> DataFrame:
    """Lines of the CSV members of every archive under ``path`` (S8), see ``ZipCatalogue``."""
    return ZipCatalogue(spark, path, member_prefix, last_member, 0, encoding, glob).lines()


def read_zip_preamble(spark: SparkSession, path: str, skip: int, member_prefix: str | None = None,
                      keep_empty: bool = False, required: Sequence[str] = (), encoding: str = "utf-8-sig",
                      glob: str = "*.zip") -> DataFrame:
    """Lines of preamble-headed members; the stem is the archive's file name before the first dot."""
    return ZipCatalogue(spark, path, member_prefix, False, skip, encoding, glob).preamble_lines(keep_empty, required)


def read_zip_headers(spark: SparkSession, path: str, member_prefix: str | None = None,
                     last_member: bool = False, encoding: str = "utf-8-sig", glob: str = "*.zip") -> DataFrame:
    """Header line of each selected member (archive, member, line_no, line)."""
    members = ZipCatalogue(spark, path, member_prefix, last_member, 0, encoding, glob).members
    return members.select("archive", "member", F.lit(0).cast("long").alias("line_no"), F.col("header").alias("line"))


def member_layouts(headers: DataFrame) -> list[str]:
    """The distinct header lines of ``read_zip_headers``, at most ``MAX_LAYOUTS``."""
    found = sorted(r["line"] for r in headers.select("line").distinct().limit(MAX_LAYOUTS + 1).collect())
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different header lines")
    return found


def member_table(lines: DataFrame, columns: Sequence[str], headers: Sequence[str] | None = None) -> DataFrame:
    """Member lines -> one text column per name; header and blank lines go.

    Each line is parsed once with Spark's own CSV parser (``from_csv``), so quoted
    commas are handled; a record may not span lines.  With ``headers`` (the
    distinct header lines, see ``member_layouts``) the fields are taken by name
    from each member's own header, null where it lacks one; without, all
    members have ``columns`` in this order.
    """
    names = {layout_of(h): header_columns(h) for h in headers or []}
    width = max([len(columns), *map(len, names.values())])
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    records = lines.filter((F.col("line_no") > 0) & (F.trim("line") != "")).select(
        "archive", "member", "layout", F.from_csv("line", ddl).alias("rec"))
    if not names:
        return records.select("archive", "member", *[F.col(f"rec.c{i}").alias(c) for i, c in enumerate(columns)])
    records = records.withColumn("fields", F.array(*[F.col(f"rec.c{i}") for i in range(width)]))
    out = []
    for c in columns:
        places = [x for k, own in names.items() if c in own for x in (F.lit(k).cast("long"), F.lit(own.index(c)))]
        out.append((F.get("fields", F.try_element_at(F.create_map(*places), F.col("layout"))) if places
                    else F.lit(None).cast("string")).alias(c))
    return records.select("archive", "member", *out)


def header_columns(header_line: str) -> list[str]:
    """Column names of one CSV header line (quotes and commas handled)."""
    return next(csv.reader([header_line]))


def archive_stems(spark: SparkSession, path: str, glob: str = "*.zip") -> list[str]:
    """Sorted stems of the archives under ``path``, from the listing only (one per
    indicator)."""
    return sorted(r["stem"] for r in _listing(spark, path, glob).select("stem").distinct().collect())
