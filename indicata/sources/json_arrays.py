"""JSON array files cut at their records, by byte ranges.

An array file of any size is read by many tasks.  The files are listed once and
cut into ranges.  What a byte means depends on all before it (inside a string?
how deep?), so the ranges are read twice: the first time each tells how it
would change that state, for both cases of its start (outside and inside a
string; whether the first byte is escaped is seen in the backslashes before
it; a file's first range needs no such reading).  The changes of a file's ranges, a few numbers each, are put together in order; the second
time each range, now knowing its start, gives the elements that begin in it and
reads on to the end of the last one, by little at first, so that small ranges cost
no more than large ones.  No file and no array is held as one text.

Text is UTF-8, with or without a byte order mark.  A file without any text has
no records.  What breaks the array itself (no array, text after its end, no end,
an empty element) is a row with a ``fault`` in place of a text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.files import open_input

SPLIT_BYTES = 128 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024
AHEAD_BYTES = 8 * 1024  # first read behind a range, for the end of its last element
ELEMENTS_SCHEMA = "file string, offset bigint, text string, fault string"
NOT_JSON = "not JSON: "
NO_LIST = "not a JSON list: "
SHOWN = 80  # characters of a faulty text in its fault
_SPACE = b" \t\r\n"
_BOM = b"\xef\xbb\xbf"
_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_IS_SPACE = np.isin(np.arange(256), list(_SPACE))
# Bytes that change the depth, and by how much.
_DELTA = np.zeros(256, np.int8)
_DELTA[[ord("["), ord("{")]] = 1
_DELTA[[ord("]"), ord("}")]] = -1
_MARK = _DELTA != 0
_MARK[_COMMA] = True


def _blocks(handle, start: int, stop: int, beyond: bool = False) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) from ``start`` to ``stop``; ``beyond``: on to the end of the file, by
    little at first, as mostly only the end of an element is wanted, then by ever larger blocks."""
    handle.seek(0)
    mark = len(_BOM) if start < len(_BOM) and handle.read(len(_BOM)) == _BOM else 0
    handle.seek(start)
    ahead = AHEAD_BYTES if beyond else 0
    while start < stop + ahead:
        data = handle.read(min(BLOCK_BYTES, stop + ahead - start))
        if not data:
            return
        blank = min(max(mark - start, 0), len(data))  # the byte order mark reads as spaces
        yield start, b" " * blank + data[blank:]
        start += len(data)
        if start >= stop + ahead:
            ahead += min(2 * ahead, BLOCK_BYTES)


def _escaped(handle, start: int) -> bool:
    """Whether an odd run of backslashes ends before ``start``."""
    run, at = 0, start
    while at > 0:
        size = min(at, 64 * 1024)
        handle.seek(at - size)
        data = handle.read(size)
        left = data.rstrip(b"\\")
        run += len(data) - len(left)
        if left:
            break
        at -= size
    return run % 2 == 1


def _quotes(a: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Places of the quotes that open or close a string, and whether the byte
    after the block is escaped."""
    found = np.flatnonzero(a == _QUOTE)
    slashes = a == _BACKSLASH
    if not escaped and not slashes.any():
        return found, False
    # Length of the run of backslashes that ends at each place; one before the block counts.
    places = np.arange(len(a))
    last = np.maximum.accumulate(np.where(slashes, -1, places))
    run = np.where(last < 0, places + 1 + escaped, places - last)
    before = np.where(found > 0, run[found - 1], int(escaped))
    return found[before % 2 == 0], bool(run[-1] % 2)


def _marks(a: np.ndarray, quotes: np.ndarray, inside: bool) -> np.ndarray:
    """Places of brackets and commas outside strings."""
    places = np.flatnonzero(_MARK[a])
    return places[(np.searchsorted(quotes, places) + inside) % 2 == 0]


def _read_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: parity of its quotes; change of depth and least depth after a bracket,
    for a start outside and inside a string; its first byte that is no space."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            with open_input(r["path"]) as handle:
                escaped, first = _escaped(handle, r["start"]), None
                parity, depth, low = 0, [0, 0], [_NO_BRACKET, _NO_BRACKET]
                escape = escaped
                for _, data in _blocks(handle, r["start"], r["stop"]):
                    a = np.frombuffer(data, np.uint8)
                    quotes, escape = _quotes(a, escape)
                    for inside in (0, 1):
                        delta = _DELTA[a[_marks(a, quotes, bool(inside ^ parity))]]
                        delta = delta[delta != 0]
                        if len(delta):
                            after = depth[inside] + np.cumsum(delta, dtype=np.int64)
                            depth[inside], low[inside] = int(after[-1]), min(low[inside], int(after.min()))
                    parity ^= len(quotes) % 2
                    if first is None and (left := data.lstrip(_SPACE)):
                        first = left[0]
            out.append({**r, "escaped": escaped, "parity": parity, "depth0": depth[0], "depth1": depth[1],
                        "low0": low[0], "low1": low[1], "first": first})
        yield pa.RecordBatch.from_pylist(out, schema=_CHANGES)


_RANGE = [("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("length", pa.int64())]
_CHANGES = pa.schema([*_RANGE, ("escaped", pa.bool_()), ("parity", pa.int32()), ("depth0", pa.int64()), ("depth1", pa.int64()),
                      ("low0", pa.int64()), ("low1", pa.int64()), ("first", pa.int32())])
_CHANGES_DDL = ("path string, start bigint, stop bigint, length bigint, escaped boolean, parity int, depth0 bigint, "
                "depth1 bigint, low0 bigint, low1 bigint, first int")
_STATES = pa.schema([*_RANGE, ("escaped", pa.bool_()), ("inside", pa.int32()), ("depth", pa.int64()), ("seen", pa.bool_()), ("closed", pa.bool_()),
                     ("lead", pa.int32())])
_STATES_DDL = ("path string, start bigint, stop bigint, length bigint, escaped boolean, inside int, depth bigint, seen boolean, "
               "closed boolean, lead int")
_NO_BRACKET = 1 << 60
_UNSEEN = -1


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the start of each range, from those before it in its file."""
    path, inside, depth, seen, closed, lead = None, 0, 0, False, False, None
    for b in batches:
        out = []
        for r in b.to_pylist():
            if r["path"] != path:
                path, inside, depth, seen, closed, lead = r["path"], 0, 0, False, False, None
            lead = r["first"] if lead is None else lead
            out.append({k: r[k] for k in ("path", "start", "stop", "length", "escaped")}
                       | {"inside": inside, "depth": depth, "seen": seen, "closed": closed, "lead": lead})
            low = r[f"low{inside}"]
            seen, closed = seen or low < _NO_BRACKET, closed or low + depth <= 0
            depth += r[f"depth{inside}"]
            inside ^= r["parity"]
        yield pa.RecordBatch.from_pylist(out, schema=_STATES)


class _Elements:
    """The elements that begin in one range."""

    def __init__(self, r: dict, handle):
        self.r, self.handle = r, handle
        self.rows: list[tuple] = []
        self.pieces: list[bytes] = []
        self.began: int | None = None  # place of the element being read
        self.alone = False  # it is the first one, so it may be missing
        self.done = False

    def fault(self, place: int, why: str, text: bytes = b"") -> None:
        self.rows.append((self.r["path"], place, None, why + text[:4 * SHOWN].decode("utf-8", "replace")[:SHOWN]))

    def element(self, data: bytes, closing: bool) -> None:
        text = b"".join([*self.pieces, data]).strip(_SPACE)
        if text:
            self.rows.append((self.r["path"], self.began, text.decode("utf-8", "replace"), None))
        elif not (closing and self.alone):
            self.fault(self.began, NOT_JSON + "an empty element")
        self.pieces, self.began = [], None

    def outside(self, place: int, data: bytes, seen: bool) -> None:
        """Text around the array may only be white space."""
        left = data.strip(_SPACE)
        if left and place < self.r["stop"] and seen:
            self.fault(place, NOT_JSON + "text after the list: ", left)

    def run(self) -> Iterator[list[tuple]]:
        r = self.r
        if r["closed"]:
            for place, data in _blocks(self.handle, r["start"], r["stop"]):
                self.outside(place, data, True)
                if self.rows:
                    yield self.rows
                    return
            return
        inside, depth, escape, seen = bool(r["inside"]), r["depth"], r["escaped"], r["seen"]
        for place, data in _blocks(self.handle, r["start"], r["stop"], beyond=True):
            if place >= r["stop"] and self.began is None:
                break
            a = np.frombuffer(data, np.uint8)
            quotes, escape = _quotes(a, escape)
            marks = _marks(a, quotes, inside)
            inside ^= bool(len(quotes) % 2)
            kinds = a[marks]
            after = depth + np.cumsum(_DELTA[kinds], dtype=np.int64)
            edge = (after == 0) & (_DELTA[kinds] < 0) | (after == 1) & ((kinds == _COMMA) | (_DELTA[kinds] > 0))
            at = 0  # of the text not yet dealt with
            for i in np.flatnonzero(edge | (after < 0)):
                where, kind = int(marks[i]), int(kinds[i])
                closing = _DELTA[kind] < 0
                if self.began is not None:
                    self.element(data[at:where], closing)
                elif after[i] - _DELTA[kind] == 0:  # outside the list up to here
                    self.outside(place + at, data[at:where], seen)
                if place + where >= r["stop"]:
                    self.done = True
                    break
                if closing and kind != ord("]") or after[i] < 0 or _DELTA[kind] > 0 and seen:
                    self.fault(place + where, NOT_JSON + "text after the list: " if seen and _DELTA[kind] > 0
                               else NOT_JSON + "brackets do not match: ", data[where:where + SHOWN])
                    self.done = True
                    break
                seen = True
                at = where + 1
                if not closing:
                    self.began, self.alone = place + at, kind == ord("[")
            if self.done:
                break
            depth = int(after[-1]) if len(after) else depth
            if self.began is not None:
                self.pieces.append(data[at:])
            elif depth == 0:
                self.outside(place + at, data[at:max(at, r["stop"] - place)], seen)
            if self.rows:
                yield self.rows
                self.rows = []
        if self.began is not None:
            self.fault(self.began, NOT_JSON + "the list does not end: ", b"".join(self.pieces).strip(_SPACE))
        if self.rows:
            yield self.rows


def _whole_file(r: dict, handle) -> list[tuple]:
    """A file that begins like no list is judged whole."""
    if r["start"]:
        return []
    handle.seek(0)
    data = handle.read()
    text = data.decode("utf-8-sig", "replace")
    try:
        json.loads(text)
        why = NO_LIST
    except ValueError:
        why = NOT_JSON
    return [(r["path"], 0, None, why + text.strip()[:SHOWN])]


def _read_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            with open_input(r["path"]) as handle:
                if r["lead"] == _UNSEEN:  # a file's first range: what leads is in it, or nothing begins there
                    text = (data.lstrip(_SPACE) for _, data in _blocks(handle, 0, r["stop"]))
                    r["lead"] = next((t[0] for t in text if t), None)
                if r["lead"] is None:
                    continue
                found = _Elements(r, handle).run() if r["lead"] == ord("[") else [_whole_file(r, handle)]
                for rows in found:
                    if rows:
                        files, offsets, texts, faults = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(files), pa.array(offsets, pa.int64()), pa.array(texts, pa.string()),
                             pa.array(faults, pa.string())], names=["file", "offset", "text", "fault"])


def array_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, stop, length): the files under ``path`` in ranges."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    step = F.lit(split_bytes).cast("long")
    ranges = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step) * step, step)).alias("start"))
    return ranges.select("path", "start", F.least(F.col("start") + step, F.col("length")).alias("stop"), "length")


def array_elements(spark: SparkSession, ranges: DataFrame) -> DataFrame:
    """(file, offset, text, fault): a row per element of each file's list, its
    place in the file and its JSON text, or what is wrong there."""
    # The state at the start of a file is known, so its first range is read once; the
    # others' states need the ranges before them.
    n = ranges.agg(F.count("*").alias("all"), F.count_if(F.col("start") > 0).alias("later")).first()
    most = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    begin = ranges.where("start = 0").select("*", *(F.lit(v).cast(k).alias(c) for c, k, v in (
        ("escaped", "boolean", False), ("inside", "int", 0), ("depth", "bigint", 0), ("seen", "boolean", False),
        ("closed", "boolean", False), ("lead", "int", _UNSEEN))))
    found = begin.repartition(max(1, min(n["all"] - n["later"], most)), "path").mapInArrow(_read_elements, ELEMENTS_SCHEMA)
    if not n["later"]:
        return found
    parts = max(1, min(n["all"], most))
    changes = ranges.repartition(parts, "path", "start").mapInArrow(_read_changes, _CHANGES_DDL)
    states = changes.repartition(parts, "path").sortWithinPartitions("path", "start").mapInArrow(_add_up, _STATES_DDL)
    later = states.where("start > 0").repartition(parts, "path", "start").mapInArrow(_read_elements, ELEMENTS_SCHEMA)
    return found.unionByName(later)
