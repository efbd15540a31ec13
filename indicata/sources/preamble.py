"""Preamble-headed CSV files, one indicator per file.

Each file: ``skip`` preamble lines, then a header line, then records; the
header may repeat further down and those copies are dropped.  Lines are
tokenised with the quoted-field rule of :mod:`indicata.functions.tokens`.

One pass over fixed splits: the files are listed once, each is cut into byte
ranges of ``split_bytes``, and a task reads its range.  A line belongs to the
range in which it starts.  Only the first lines of a file need a position:
every range reads the file's head (its first lines, a few kilobytes) for the
header and the place where the records start.  The ranges are part of the
plan, so the result does not depend on how many tasks or executors run it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.files import file_stem, open_input
from indicata.functions.tokens import (CSV_FIELD_PATTERN, QUOTED_TOKEN_PATTERN_POSSESSIVE, clean_tokens, field_by_name,
                                       split_quoted)

# Lines before the header in each file of the source folder.
PREAMBLE_LINES = 4

SPLIT_BYTES = 128 * 1024 * 1024
_CHUNK_BYTES = 8 * 1024 * 1024
_HEAD_BYTES = 64 * 1024
LINES_SCHEMA = "file string, stem string, offset bigint, line string, header_raw array<string>"


def header_tokens(line: str, keep_empty: bool = False) -> list[str]:
    """The raw tokens of one line, as ``split_quoted`` gives them."""
    if keep_empty:
        return re.findall(CSV_FIELD_PATTERN, "," + line)
    return re.findall(QUOTED_TOKEN_PATTERN_POSSESSIVE, line)


def check_header(name: str, tokens: Sequence[str], required: Sequence[str]) -> None:
    """Fail, naming the file, if a required column is not in its header."""
    found = {t.replace('"', "").strip() for t in tokens}
    missing = [c for c in required if c not in found]
    if missing:
        raise ValueError(f"{name}: header lacks {missing}")


def _read_head(handle, skip: int) -> tuple[bytes | None, int]:
    """The line after ``skip`` lines and the place after it; None if there is none."""
    head = b""
    while head.count(b"\n") <= skip:
        part = handle.read(_HEAD_BYTES)
        if not part:
            break
        head += part
    lines = head.split(b"\n")
    if len(lines) <= skip or (len(lines) == skip + 1 and not lines[skip]):
        return None, len(head)
    return lines[skip], sum(len(x) + 1 for x in lines[: skip + 1])


def _blocks(handle, start: int, stop: int, body: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of whole lines: those that start in [start, stop), from
    ``body`` on; every block but a file's last ends with a line feed."""
    pos = max(start, body)
    if start > body:  # the line that runs into this range belongs to the one before
        handle.seek(start - 1)
        pos = start - 1
        while True:
            part = handle.read(_HEAD_BYTES)
            if not part:
                return
            at = part.find(b"\n")
            if at >= 0:
                pos += at + 1
                break
            pos += len(part)
    if pos >= stop:
        return
    handle.seek(pos)
    carry, carried = b"", pos
    while pos < stop:
        part = handle.read(min(_CHUNK_BYTES, stop - pos))
        if not part:
            break
        pos += len(part)
        data = carry + part
        cut = data.rfind(b"\n") + 1
        if cut:
            yield carried, data[:cut]
        carry, carried = data[cut:], carried + cut
    if carry:  # the last line started in this range: read on to its end
        while b"\n" not in carry:
            part = handle.read(_HEAD_BYTES)
            if not part:
                break
            carry += part
        cut = carry.find(b"\n") + 1
        yield carried, carry[:cut] if cut else carry


def _line_batch(path: str, stem: str, offset: int, data: bytes, header: pa.Scalar) -> pa.RecordBatch:
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts = np.concatenate([[0], ends + 1])
    if data.endswith(b"\n"):
        starts, data = starts[:-1], data[:-1]
    lines = pc.utf8_rtrim(pc.split_pattern(pa.array([data.decode("utf-8", "replace")]), "\n").flatten(), "\r")
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(path, n), pa.repeat(stem, n), pa.array(offset + starts, pa.int64()), lines, pa.repeat(header, n)],
        names=["file", "stem", "offset", "line", "header_raw"])


def _read_ranges(skip: int, keep_empty: bool, required: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with open_input(r["path"]) as handle:
                    head, body = _read_head(handle, skip)
                    if head is None:
                        continue
                    tokens = header_tokens(head.decode("utf-8", "replace").rstrip("\r"), keep_empty)
                    check_header(r["path"], tokens, required)
                    header = pa.scalar(tokens, pa.list_(pa.string()))
                    for offset, data in _blocks(handle, r["start"], r["stop"], body):
                        yield _line_batch(r["path"], r["stem"], offset, data, header)
    return run


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, stem, length) of the files, from the listing only."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.select("path", file_stem(F.element_at(F.split("path", "/"), -1)).alias("stem"), "length")


def preamble_lines(spark: SparkSession, path: str, skip: int = PREAMBLE_LINES, keep_empty: bool = False,
                   required: Sequence[str] = (), split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines after the header of every file under ``path``: file, stem, offset
    (byte place in the file), line, header_raw (the file's raw header tokens).

    Line ends are ``\\n`` or ``\\r\\n``.  A header without one of the ``required``
    names fails the job and names the file."""
    step = F.lit(split_bytes)
    ranges = _listing(spark, path).where("length > 0").select("path", "stem", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step) * step, step.cast("long"))).alias("start"))
    ranges = ranges.select("path", "stem", "start", F.least(F.col("start") + step, F.col("length")).alias("stop"))
    parts = max(1, min(ranges.count(), 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = ranges.repartition(parts, "path", "start")  # a row per range: only the list is shuffled
    return dealt.mapInArrow(_read_ranges(skip, keep_empty, tuple(required)), LINES_SCHEMA)


def preamble_records(lines: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Records of lines (file, stem, offset, line, header_raw): file, stem,
    offset, tokens and header (cleaned arrays) (S4, R5, R6).

    Rows equal to their header (compared as raw tokens, before cleaning) go.
    The line is tokenised inside a generator, so it is done once."""
    raw = F.array(F.struct(split_quoted("line", keep_empty).alias("raw")))
    kept = lines.select("file", "stem", "offset", "header_raw", F.inline(
        F.filter(raw, lambda r: r["raw"] != F.col("header_raw"))))
    return kept.select("file", "stem", "offset", clean_tokens("raw").alias("tokens"),
                       clean_tokens("header_raw").alias("header"))


def read_preamble_lines(spark: SparkSession, path: str, skip: int = PREAMBLE_LINES, keep_empty: bool = False,
                        required: Sequence[str] = (), split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of every file in a folder, with the file's header."""
    return preamble_records(preamble_lines(spark, path, skip, keep_empty, required, split_bytes), keep_empty)


def indicator_values(records: DataFrame, key: str, value: str) -> DataFrame:
    """Long table (stem, key, value text) from preamble records."""
    return records.select("stem",
                          field_by_name("tokens", "header", key).alias(key),
                          field_by_name("tokens", "header", value).alias(value))


def read_indicator_folder(spark: SparkSession, path: str, key: str, value: str, skip: int = PREAMBLE_LINES,
                          keep_empty: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Long table (stem, key, value text) of a folder of indicator files.

    One scan of the whole folder; the file stem names the indicator.  A file
    whose header lacks either name fails the job."""
    return indicator_values(read_preamble_lines(spark, path, skip, keep_empty, (key, value), split_bytes), key, value)


def folder_stems(spark: SparkSession, path: str) -> list[str]:
    """Sorted stems of the files in a folder, from the file listing only (one
    row per distinct stem, that is per indicator, reaches the driver)."""
    return sorted(r["stem"] for r in _listing(spark, path).select("stem").distinct().collect())
